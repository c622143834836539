"""The split reader against the whole-file reader, at every size of a split."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest

from annolab.sources import arrays as A
from annolab.sources.annotations import all_records, quarantine, read_annotations, read_files, split_records, usable


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    def set_to(n):
        spark.conf.set(names[0], n)
        spark.conf.set(names[1], "1")
    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v)


def files(seed):
    r = random.Random(seed)
    def text():
        return "".join(r.choice(['a', 'é', '日', '"', '\\', '}', '{', '[', ']', ',', ' ', '\n', '\\"', '\\\\"}']) for _ in range(r.randint(0, 12)))
    def record():
        k = r.random()
        if k < 0.1:
            return r.choice([5, None, "a string, with } and ]", [1, [2, {"x": "]"}]], True, {}, ""])
        return {"data": {"text": text(), "n": [1, {"y": [text()]}]}, "annotations": [{"result": [{"value": {"choices": [r.choice("12345") + text()]}}]}]}
    good = [json.dumps([record() for _ in range(r.randint(1, 4))], ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])) for _ in range(3)]
    one = json.dumps([record() for _ in range(2)])
    return {
        **{f"good{i}.json": g for i, g in enumerate(good)}, "consensus/c.json": json.dumps([record(), record()]),
        "empty.json": "[]", "white.json": " \n[ \n ]\n ", "object.json": json.dumps(record() if r.random() < 0.5 else {"a": text()}),
        "ends.json": '{"a":{}}', "number.json": "17", "text.json": '"a } string"', "cut.json": one[:-r.randint(1, 20)],
        "more.json": one + r.choice([" x", "}", ","]), "comma.json": one[:-1] + ",]", "lead.json": "[," + one[1:],
        "brace.json": one[:-1] + "}", "middle.json": one[:-1] + ',{"a":},' + one[1:], "bare.json": "[1 2]", "far.json": "\t \n" * 12 + one,
        "open.json": '[{"a":"', "deep.json": json.dumps([[[[{"a": [record()]}]]]]), "blank.json": "  \n ",
        "bom.json": "﻿" + one, "nan.json": '[{"text":"d","x":NaN}]', "twice.json": '[{"text":"a","text":"b"}]',
    }


def in_ranges(data: bytes, cuts: list, batch: int) -> list:
    """What the tasks make of the ranges of one file: (position, text) of its elements, and
    whether it closed. ``cuts``: fragments per range."""
    parts = data.split(b"}")                                 # as the text source, the last one without a mark
    if parts[-1] == b"":
        parts.pop()
    at, groups = 0, []
    for n in cuts + [len(parts)]:
        if parts[at:at + n]:
            groups.append((sum(len(p) + 1 for p in parts[:at]), parts[at:at + n]))
        at += n
    def batches(start, frags):
        for i in range(0, len(frags), batch):
            part = frags[i:i + batch]
            yield pa.RecordBatch.from_pydict({"path": ["f"] * len(part), "start": [start] * len(part), "single": [len(groups) == 1] * len(part),
                                              "size": [len(data)] * len(part), "body": pa.array(part, pa.binary())})
    inside = depth = 0
    first, names, states, out = None, [], [], []
    found = [b.to_pylist()[0] for start, frags in groups for b in A.transfer(batches(start, frags))]
    assert len(found) == (len(groups) if len(groups) > 1 else 0)
    for r in found:
        first = r["first"] if first is None else first
        names.append(A._name("f", r["start"]))
        states.append((inside, depth))
        depth += r["change_in"] if inside else r["change_out"]
        inside ^= r["odd"]
    order = np.argsort(names) if names else []
    class shared:
        value = (np.array(sorted(names), dtype="S52"), np.array([states[i][0] for i in order]), np.array([states[i][1] for i in order]),
                 np.array([-1 if first is None else first for _ in order]))
    for start, frags in groups:
        for b in A.cut(shared)(batches(start, frags)):
            out += b.to_pylist()
    offset, closed, texts = 0, False, {}
    for start, _ in groups:
        own = [r for r in out if r["start"] == start]
        for r in own:
            if r["kind"] in (A.WHOLE, A.PART):
                texts.setdefault(offset + r["place"], []).append(r["body"])
            if r["kind"] == A.RANGE:
                closed, n = closed or r["closed"], r["place"]
        offset += n
    return [b"".join(texts[i]).strip() for i in sorted(texts)], closed


@pytest.mark.parametrize("seed", range(8))
def test_every_way_to_divide_a_file(seed):
    r = random.Random(seed)
    for name, body in files(seed).items():
        if not name.startswith(("good", "far", "deep", "nan")):
            continue
        data = body.encode()
        want = [json.dumps(x) for x in json.loads(body)]
        n = data.count(b"}") + 1
        for cuts in ([], [1] * n, [r.randint(1, 4) for _ in range(n)], [r.randint(1, n)]):
            got, closed = in_ranges(data, cuts, r.choice([1, 2, 5, 100]))
            assert closed and [json.dumps(json.loads(x)) for x in got] == want, (name, cuts)


@pytest.mark.parametrize("seed,size", [(1, 1 << 20), (2, 4000)])
def test_equals_the_whole_file_reader(spark, tmp_path, small_splits, seed, size):
    small_splits(size)
    for name, body in files(seed).items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body, encoding="utf-8")
    root = str(tmp_path)
    def rows(classified, recs):
        return (sorted(map(tuple, usable(recs).select("filename", "pos", "kind", "text", "label_raw", "label", "doc_id").collect()), key=str),
                sorted(((r.path.rsplit("/", 1)[1], r.pos, r.reason, r.detail) for r in quarantine(classified, recs).collect()), key=str))
    old = rows(*all_records(spark, read_files(spark, root), root))
    new = rows(*split_records(spark, root))
    assert new[1] == old[1]
    assert new[0] == old[0] and len(new[0]) > 8


@pytest.mark.parametrize("size", [1 << 20])
def test_what_follows_an_array_makes_it_malformed(spark, tmp_path, small_splits, size):
    small_splits(size)
    for i, body in enumerate(("[1,2] [3]", '[{"text":"a"}]]', '[{"text":"a"}][]', '[{"text":"a"}] {}', '[{"text":"a"}]}')):
        (tmp_path / f"{i}.json").write_text(body)
    recs, bad = read_annotations(spark, str(tmp_path))
    assert recs.collect() == [] and [r.reason for r in bad.collect()] == ["malformed"] * 5


def test_one_line_is_read_by_many_tasks(spark, tmp_path, small_splits):
    from annolab.sources.arrays import fragments

    small_splits(1 << 20)
    record = '{"text":"%s","annotations":[{"result":[{"value":{"choices":["%d"]}}]}]}'
    n = 12_000
    (tmp_path / "big.json").write_text("[" + ",".join(record % ("}, {" * 200 + str(i), 1 + i % 5) for i in range(n)) + "]")
    assert fragments(spark, str(tmp_path)).select("start").distinct().count() >= 8
    recs, bad = read_annotations(spark, str(tmp_path))
    got = recs.select("pos", "text", "label").collect()
    assert bad.count() == 0 and sorted((r.pos, r.text[1000 - 200:], r.label) for r in got) == [
        (i, str(i), 1 + i % 5) for i in range(n)]


def test_no_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("[]")
    (tmp_path / "y.json").write_text("")
    recs, bad = read_annotations(spark, str(tmp_path))
    assert recs.collect() == [] and bad.collect() == []
