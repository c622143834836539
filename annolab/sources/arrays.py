"""JSON arrays read by many tasks each (S01, S02): the elements of every ``*.json`` file
below a root, with their positions, however large a file is and even if it is one line.

The text source reads a file split by split if its records end with a given
character; here a "record" is what stands between two ``}``, which says nothing
about JSON yet, but gives every task its byte range in order. What a range means depends
on the state at its start: inside a string or not, and how deep in brackets.

1. Of each range of a divided file: does it hold an odd number of quotes (an escaped one is
   none; a range begins behind ``}``, so no escape reaches across), and by how much do its
   brackets change the depth, for both cases of the string state. These transfer functions
   compose by two running sums over the ranges of a file.
2. With its start state each range is cut at the commas of depth 1. An element inside one range
   goes out whole, the ends of ranges as parts with the range and the number of commas
   before them in it; commas of the ranges before make this a position in the file. Parts
   of one element are put together by (file, position).
3. Every element is parsed by itself. A file is malformed if one of its elements is, if it does not
   close, or if something follows its end.

A task holds a batch of ``}``-fragments and the element it is in. The driver and the tasks hold the
start states of divided files: ``STATE_BYTES`` a range.

Files without bytes are not seen (Spark's file sources skip them). A byte order mark makes a
file malformed, as for any JSON reader. Files that are no array are told from broken ones by
parsing them whole, in one row each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings
from annolab.session import materialize, ship_package

MARK = "}"
STATE_BYTES = 80                # of a range, in the broadcast
MOST_RANGES = 8_000_000         # of divided files (at 128 MB a range: 1 PB)
RANGES = "path string, start long, odd int, change_out long, change_in long, first int"
#: kind: what a row is. WHOLE an element, PART of one, TAIL behind the array, BODY of a file that is
#: no array, RANGE the counts of a range (n commas, whether the array closed in it, bytes and fragments read)
WHOLE, PART, TAIL, BODY, RANGE = range(5)
PIECES = "path string, start long, kind int, place long, seq long, body binary, closed boolean, bytes long, fragments long, size long"

WHITE = b" \t\n\r"
STEP = np.zeros(256, dtype=np.int64)
STEP[[91, 123]], STEP[[93, 125]] = 1, -1
CHOSEN = np.zeros(256, dtype=bool)
CHOSEN[[91, 123, 93, 125, 44]] = True


def fragments(spark: SparkSession, root: str, settings: Settings = DEFAULTS) -> DataFrame:
    """(path, start, single, size, body) of every fragment, in the order of the ranges."""
    raw = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", settings.file_glob)
           .option("lineSep", MARK).text(root))
    m = "_metadata.file_"
    return raw.select(F.col(m + "path").alias("path"), F.col(m + "block_start").alias("start"),
                      (F.col(m + "block_length") == F.col(m + "size")).alias("single"), F.col(m + "size").alias("size"),
                      F.col("value").cast("binary").alias("body"))


def ranges(batches):
    """(path, start, single, size, fragments) of consecutive rows of a range."""
    for batch in batches:
        path, start = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        body = batch.column(4).to_pylist()
        at = 0
        for i in range(1, len(path) + 1):
            if i == len(path) or start[i] != start[at] or path[i] != path[at]:
                yield path[at], start[at], batch.column(2)[at].as_py(), batch.column(3)[at].as_py(), body[at:i]
                at = i


class Scan:
    """The brackets, commas and quotes of consecutive fragments."""

    def __init__(self, parts: list):
        self.data = MARK.encode().join(parts) + MARK.encode()
        b = np.frombuffer(self.data, dtype=np.uint8)
        quotes = np.flatnonzero(b == 34)
        after = quotes[(quotes > 0) & (b[quotes - 1] == 92)]
        if len(after):                                       # an odd run of backslashes escapes a quote
            plain = np.where(b != 92, np.arange(len(b)), -1)
            run = after - 1 - np.maximum.accumulate(plain)[after - 1]
            quotes = np.setdiff1d(quotes, after[run % 2 == 1], assume_unique=True)
        self.odd = len(quotes) % 2
        self.at = np.flatnonzero(CHOSEN[b])
        self.char = b[self.at]
        self.within = np.searchsorted(quotes, self.at) % 2 == 1

    def first(self):
        rest = self.data.lstrip(WHITE)
        return rest[0] if rest else None


def transfer(batches):
    """Rows of RANGES for the ranges of divided files; a range may give several rows, in order."""
    held: dict = {}

    def row(key):
        v = held.pop(key)
        return pa.RecordBatch.from_pydict({"path": [key[0]], "start": [key[1]], "odd": pa.array([v[0]], pa.int32()),
                                           "change_out": [v[1]], "change_in": [v[2]], "first": pa.array([v[3]], pa.int32())})

    for path, start, single, _, parts in ranges(batches):
        if single:
            continue
        if held and (path, start) not in held:
            yield row(next(iter(held)))
        v = held.setdefault((path, start), [0, 0, 0, None])
        scan = Scan(parts)
        step = STEP[scan.char]
        out, inside = int(step[~scan.within].sum()), int(step[scan.within].sum())
        if v[0]:                                             # the range's start state is told from its beginning
            out, inside = inside, out
        v[0], v[1], v[2], v[3] = v[0] ^ scan.odd, v[1] + out, v[2] + inside, scan.first() if v[3] is None else v[3]
    for key in list(held):
        yield row(key)


def start_states(found: DataFrame) -> DataFrame:
    """(path, start, inside, depth, first byte of the file that is no white space) of each range."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    known = found.select("path", "start", "change_out", "change_in", inside.alias("inside"),
                         F.first("first", ignorenulls=True).over(whole).alias("first"))
    change = F.when(F.col("inside") == 1, F.col("change_in")).otherwise(F.col("change_out"))
    return known.select("path", "start", "inside", "first",
                        F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth"))


class Cutter:
    """Cuts one range at the commas of depth 1."""

    def __init__(self, path, start, single, size, inside, depth, first):
        self.key, self.size, self.start, self.single = (path, start), size, start, single
        self.inside, self.depth, self.first = inside, depth, first
        self.begun = depth > 0 or start > 0                  # the opening bracket is behind us
        self.closed = depth <= 0 and start > 0
        self.n = self.bytes = self.fragments = self.seq = 0
        self.held: list = []                                 # of the element we are in
        self.cut = start > 0                                 # it began in another range

    def rows(self, parts):
        self.bytes += sum(map(len, parts))
        self.fragments += len(parts)
        scan = Scan(parts)
        if self.first is None:
            self.first = scan.first()
        if self.first is not None and self.first != 91:
            yield self.row(BODY, scan.data)
            return
        outside = scan.within if self.inside else ~scan.within
        self.inside ^= scan.odd
        at, char = scan.at[outside], scan.char[outside]
        depth = self.depth + np.cumsum(STEP[char])
        if len(depth):
            self.depth = int(depth[-1])
        place = 0
        if not self.begun:
            if not len(at):                                  # white space up to here
                return
            self.begun, place = True, int(at[0]) + 1
        if self.closed:
            yield self.row(TAIL, scan.data)
            return
        shut = np.flatnonzero(depth == 0)
        end = int(shut[0]) if len(shut) else len(at)
        for c in at[:end][(char[:end] == 44) & (depth[:end] == 1)].tolist():
            self.held.append(scan.data[place:c])
            yield self.element()
            self.n, place, self.cut = self.n + 1, c + 1, False
        if len(shut):
            c = int(at[end])
            self.held.append(scan.data[place:c])
            yield self.element()
            self.closed = True
            yield self.row(TAIL, scan.data[c:])              # from the closing bracket on
        else:
            self.held.append(scan.data[place:])

    def element(self):
        body, self.held = b"".join(self.held), []
        return self.row(PART if self.cut else WHOLE, body)

    def row(self, kind, body):
        self.seq += 1
        return (*self.key, kind, self.n, self.seq, body, None, None, None, None)

    def finish(self):
        if self.held:                                        # goes on in the next range
            yield self.row(PART, b"".join(self.held))
        yield (*self.key, RANGE, self.n, 0, None, self.closed, self.bytes, self.fragments, self.size)


def cut(shared):
    def run(batches):
        names, inside, depth, first = shared.value
        cutter, out, size = None, [], 0

        def batch():
            cols = list(zip(*out))
            out.clear()
            types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=[f.split()[0] for f in PIECES.split(", ")])

        for path, start, single, length, parts in ranges(batches):
            if cutter is None or cutter.key != (path, start):
                if cutter is not None:
                    out += cutter.finish()
                state = (0, 0, None)
                if not single:
                    i = int(np.searchsorted(names, _name(path, start)))
                    if i == len(names) or names[i] != _name(path, start):
                        raise ValueError(f"{path} changed while it was read")
                    state = (int(inside[i]), int(depth[i]), int(first[i]) if first[i] >= 0 else None)
                cutter = Cutter(path, start, single, length, *state)
            for row in cutter.rows(parts):
                out.append(row)
                size += len(row[5])
                if size > 4 << 20 or len(out) >= 4096:
                    yield batch()
                    size = 0
        if cutter is not None:
            out += cutter.finish()
        if out:
            yield batch()
    return run


def _name(path: str, start: int) -> bytes:
    return hashlib.md5(path.encode()).hexdigest().encode() + b"%020d" % start


def read_elements(spark: SparkSession, root: str, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(files, elements): files (path, reason) with reason NULL for good ones; elements (path, pos,
    rec, v) of good files, rec the element's text (NULL for null, a string without its quotes)
    and v its value."""
    ship_package(spark)
    found = fragments(spark, root, settings)
    known = start_states(materialize(found.mapInArrow(transfer, RANGES), "ranges"))
    states = materialize(known.select(F.concat(F.md5(F.col("path").cast("binary")), F.format_string("%020d", "start")).alias("name"),
                                      "inside", "depth", F.coalesce("first", F.lit(-1)).alias("first")), "states")
    if states.count() > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges of divided files: raise spark.sql.files.maxPartitionBytes")
    table = states.orderBy("name").toArrow()
    shared = spark.sparkContext.broadcast((np.array(table.column("name").to_pylist(), dtype="S52"), *[
        table.column(c).to_numpy() for c in ("inside", "depth", "first")]))
    pieces = materialize(found.mapInArrow(cut(shared), PIECES), "pieces")

    per_file = Window.partitionBy("path").orderBy("start")
    spans = (pieces.where(F.col("kind") == RANGE)
             .withColumn("offset", F.coalesce(F.sum("place").over(per_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    offsets = spans.where("offset > 0").select("path", "start", "offset")
    placed = (pieces.where(F.col("kind").isin(WHOLE, PART)).join(offsets, ["path", "start"], "left")
              .select("path", (F.col("place") + F.coalesce("offset", F.lit(0))).cast("int").alias("pos"),
                      "kind", "start", "seq", "body"))
    whole = placed.where(F.col("kind") == WHOLE).select("path", "pos", F.col("body").cast("string").alias("raw"))
    parts = _together(placed.where(F.col("kind") == PART), "path", "pos")
    # an element that ends a range may be blank there, and alone in its file: an empty array
    raw = whole.unionByName(parts)
    texts, values = (F.from_json(F.concat(F.lit("["), "raw", F.lit("]")), f"array<{t}>") for t in ("string", "variant"))
    parsed = raw.select("path", "pos", texts.alias("t"), values.alias("vs"), F.col("raw").rlike(r"^\s*$").alias("blank"))
    parsed = materialize(parsed.select("path", "pos", "blank", (F.col("t").isNull() | (F.size("t") != 1)).alias("broken"),
                                       F.get("t", F.lit(0)).alias("rec"), F.get("vs", F.lit(0)).alias("v")), "elements")

    per = parsed.groupBy("path").agg(F.max("broken").alias("broken"), F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank"))
    whole_file = spans.groupBy("path").agg(F.max("closed").alias("closed"), (F.first("size") - F.sum("bytes") - F.sum("fragments") + 1)
                                           .alias("more"))
    tail = _together(pieces.where(F.col("kind") == TAIL), "path").select("path", F.col("raw").alias("tail"))
    body = _together(pieces.where(F.col("kind") == BODY), "path").select("path", F.col("raw").alias("body"))
    # the last fragment has a mark put behind it that the file may not have: more = 0
    ended = F.col("tail").rlike(r"^\][\s]*\}$") & (F.col("more") == 0)
    own = F.when(F.col("more") % 3 == 0, F.expr("substring(body, 1, length(body) - 1)")).otherwise(F.col("body"))
    files = (whole_file.join(per, "path", "left").join(tail, "path", "left").join(body, "path", "left")
             .withColumn("own", own).select("path", (
                 F.when(F.col("body").isNotNull(), F.when(F.expr("try_parse_json(own)").isNull(), "malformed").otherwise("not_a_list"))
                 .when(F.coalesce(F.col("closed") & ended & (F.col("n") == 1) & F.col("blank"), F.lit(False)), "empty")
                 .when(~F.coalesce(F.col("closed") & ended & ~F.col("broken"), F.lit(False)), "malformed")).alias("reason")))
    files = materialize(files, "files")
    good = parsed.join(files.where("reason IS NULL").select("path"), "path", "left_semi")
    return files, good.select("path", "pos", "rec", "v")


def _together(pieces: DataFrame, *key: str) -> DataFrame:
    """Pieces of a key as one text, in order."""
    got = pieces.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "seq", "body"))).alias("p"))
    return got.select(*key, F.array_join(F.transform("p", lambda p: p["body"].cast("string")), "").alias("raw"))
