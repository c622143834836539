import json
import os

from annolab.functions.extract import extract_records
from annolab.sources.annotations import read_annotations

CASES = [
    ('{"data":{"text":null},"text":"x"}', None, None),
    ('{"data":{"other":1},"text":"x"}', "x", None),
    ('{"z":1,"b":"  ","m":"first","a":"second"}', "first", None),
    ('{"text":"   ","annotations":[{"result":[{"value":{"choices":["3 - medium"]}}]}]}', "   ", 3),
    ('{"text":"t","annotations":[{"result":[{"value":{"choices":[["4","5"]]}}]}]}', "t", 4),
    ('{"text":"t","annotations":[{"result":[{"value":{"choices":["10"]}}]}]}', "t", 1),
    ('{"text":"t","annotations":[{"result":[{"value":{"choices":[""]}}]}]}', "t", None),
    ('{"text":"t","annotations":[{"result":[{"value":{"choices":[]}}]}]}', "t", None),
    ('{"text":"t","annotations":{}}', "t", None),
    ('{"text":"t","annotations":{"0":1}}', "t", None),
    ('{"text":"t","annotations":["str"]}', "t", None),
    ('{"data":"str","content":"c"}', "c", None),
    ('{"n":5}', None, None),
    ('{"data":{"text":7}}', "7", None),
    # falsy values are no text, and there is no fall-through
    ('{"text":0,"content":"c"}', None, None), ('{"text":false}', None, None), ('{"text":[]}', None, None),
    ('{"text":{}}', None, None), ('{"text":0.0}', None, None), ('{"text":""}', "", None),
    ('{"text":true}', "true", None), ('{"text":"0"}', "0", None),
    # a string in place of the choices is indexed
    ('{"text":"t","annotations":[{"result":[{"value":{"choices":"3 - medium"}}]}]}', "t", 3),
    ('{"text":"t","annotations":[{"result":[{"value":{"choices":""}}]}]}', "t", None),
    ('{"text":"t","annotations":[{"result":[{"value":{"choices":["N/A"]}}]}]}', "t", None),
    # a repeated key keeps its last value
    ('{"text":"a","n":1,"text":"b","annotations":[{"result":[{"value":{"choices":["2"]}}]}]}', "b", 2),
]


def test_record_extraction(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(CASES)], "i int, rec string")
    got = {r.i: (r.text, r.label) for r in extract_records(df).collect()}
    for i, (_, text, label) in enumerate(CASES):
        assert got[i] == (text, label), CASES[i][0]


def test_file_scan_quarantine_and_kinds(spark, tmp_path):
    root = tmp_path / "data"
    (root / "x" / "consensus").mkdir(parents=True)
    (root / "reg dir é").mkdir(parents=True)
    ann = lambda t, c: {"text": t, "annotations": [{"result": [{"value": {"choices": [c]}}]}]}
    json.dump([{"data": {"text": "A"}, "annotations": [{"result": [{"value": {"choices": ["2"]}}]}]},
               5, '{"text":"fake"}', ann("B", "4")], open(root / "x" / "consensus" / "c1.json", "w"))
    json.dump([ann("A", "1"), ann("C", "5")], open(root / "reg dir é" / "r1.json", "w"))
    (root / "bad.json").write_text('{"text": 1}')
    (root / "mal.json").write_text('[{"text": ')
    (root / "empty.json").write_text("[]")
    (root / "skip.JSON").write_text('[{"text":"no"}]')
    recs, q = read_annotations(spark, str(root))
    got = sorted((r.filename, r.kind, r.pos, r.text, r.label) for r in recs.collect())
    assert got == [("c1.json", "consensus", 0, "A", 2), ("c1.json", "consensus", 3, "B", 4),
                   ("r1.json", "regular", 0, "A", 1), ("r1.json", "regular", 1, "C", 5)]
    reasons = {(os.path.basename(r.path), r.pos): r.reason for r in q.collect()}
    assert reasons == {("bad.json", None): "not_a_list", ("mal.json", None): "malformed", ("empty.json", None): "empty",
                       ("c1.json", 1): "not_an_object", ("c1.json", 2): "not_an_object"}


def test_nothing_is_lost(spark, tmp_path):
    """Every element of a file is a record or has a quarantine row."""
    ann = ',"annotations":[{"result":[{"value":{"choices":["%s"]}}]}]}'
    parts = ['{"text":"a"' + ann % "1", '{"text":"b","text":"c"' + ann % "2", '{"text":"d","x":NaN' + ann % "3",
             '{"text":"e"' + ann % "N/A", "null", "[1]", '{"text":"f"' + ann % "4"]
    (tmp_path / "a.json").write_text("[\n" + ",\n".join(parts) + "\n]\n")
    (tmp_path / "trailing.json").write_text('[{"text":"x"}] and more')
    recs, q = read_annotations(spark, str(tmp_path))
    got = {r.pos: (r.text, r.label_raw, r.label) for r in recs.collect()}
    assert got == {0: ("a", "1", 1), 1: ("c", "2", 2), 2: ("d", "3", 3), 3: ("e", "N", None), 6: ("f", "4", 4)}
    bad = {(os.path.basename(r.path), r.pos, r.reason) for r in q.collect()}
    assert bad == {("a.json", 3, "label_not_integer"), ("a.json", 4, "not_an_object"), ("a.json", 5, "not_an_object"),
                   ("trailing.json", None, "malformed")}


def test_root_name_decides_nothing(spark, tmp_path):
    root = tmp_path / "consensus" / "project"
    (root / "consensus").mkdir(parents=True)
    for name in ("r.json", "consensus/c.json"):
        (root / name).write_text('[{"text":"a"}]')
    kinds = {r.filename: r.kind for r in read_annotations(spark, str(root))[0].collect()}
    assert kinds == {"r.json": "regular", "c.json": "consensus"}


def test_file_over_128_mb(spark, tmp_path):
    record = '{"text":"%s","annotations":[{"result":[{"value":{"choices":["1"]}}]}]}' % ("long text " * 1000)
    with open(tmp_path / "big.json", "w") as f:
        f.write("[" + ",".join([record] * 13_600) + "]")
    assert os.path.getsize(tmp_path / "big.json") > 128 << 20
    recs, q = read_annotations(spark, str(tmp_path))
    assert recs.where("label = 1").count() == 13_600 and q.count() == 0


def test_vote_on_raw_labels(spark):
    from annolab.plans.dataset import build_dataset
    rows = [("1", 1, "f", "consensus", "t", "N"), ("2", 2, "f", "consensus", "t", "N"), ("3", 3, "f", "consensus", "t", "2"),
            ("4", 4, "f", "consensus", "u", "3"), ("5", 5, "r", "regular", "t", "1"), ("6", 6, "r", "regular", "v", "1")]
    df = spark.createDataFrame(rows, "doc_id string, seq long, filename string, kind string, text string, label_raw string") \
        .selectExpr("*", "try_cast(label_raw AS INT) AS label")
    parts = build_dataset(df)
    assert {r.text: r.label for r in parts.voted.collect()} == {"t": None, "u": 3}
    assert [r.doc_id for r in parts.kept.collect()] == ["6"]                    # t stays a consensus text
    assert [r.text for r in parts.complete.where("split = 'test'").collect()] == ["u"]


def test_list_behind_much_white_space(spark, tmp_path):
    (tmp_path / "far.json").write_text(" \n\t" * 2000 + '[{"text":"t"}]')
    (tmp_path / "no.json").write_text(" " * 5000 + '{"text":"t"}')
    records, quarantined = read_annotations(spark, str(tmp_path))
    assert [r.text for r in records.collect()] == ["t"]
    assert [(os.path.basename(r.path), r.reason) for r in quarantined.collect()] == [("no.json", "not_a_list")]
