"""MinHash near-dedup by a signature-coordinate inverted join.

A document's set are its distinct shingles of ``shingle`` words. Two documents are
linked when 100 * intersection >= ``need`` * union of their full sets; the result is
the smallest document reachable over links. The defaults, 3 words and 85, are op9's;
the pipeline's stage adds the links of 5 words and 80.

1. Documents with equal sets become one class (smallest id = representative).
2. Signature: ``COORDINATES`` coordinates, each the minima under ``WIDTH``
   permutations taken together, so a coordinate agrees with probability J^3 and
   texts that merely share a line rarely meet. ``matches_for`` gives the number of
   coordinates asked for: linked documents agree in fewer with probability below
   1e-7 (2.0e-9 with 7 of 40 at J = 0.85, 4.3e-8 with 5 of 40 at J = 0.8).
3. Inverted join: representatives are posted under each (coordinate, value) of
   the prefix of 40 - matches + 1 coordinates (whoever agrees in that many agrees
   in one of these). Lists of one are dropped. Inside a list the agreeing coordinates are
   counted; a document that is already connected is skipped, so a list of n
   posts at most n - 1 pairs. Lists over ``LIST`` documents are not counted at
   all but joined as a star, which only makes step 4 look at more.
4. The connected pairs form families. A family's full sets meet in one task,
   in blocks of bounded size; a family of several blocks meets in all pairs of
   blocks. Exact tests run outward from one document over those not yet
   connected, so each task returns a spanning forest of the true links and no
   link between components is lost.
5. Connected components of the forests by minimum labels and pointer jumping, each
   step a written table.

Defined cases: NULL, empty and wordless texts have n_shingles 0 and are linked with
nothing; fewer words than a shingle has are one shingle; a document with NULL id takes no part
(component NULL, kept); rows that share an id are judged row by row, each by its own
text; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolab.llm import common as C
from annolab.llm.common import U

SHINGLE = 3
NEED = 85                  # per cent of the union
WIDTH = 3
COORDINATES = 40
MATCHES = 7                # at most; fewer for a lower need
MISS = 1e-7
LIST = 20_000              # documents of a list whose coordinates are counted
BLOCK = 2_000_000          # shingles of a block of a family
SEEDS = np.random.default_rng(11).integers(1, 2 ** 63, WIDTH * COORDINATES, dtype=np.uint64) * U(2) + U(1)
SIGNATURES = "doc_id long, chunk long, doc int, n long, set_key binary, coordinates binary"


def matches_for(need: int) -> int:
    """The most coordinates, up to MATCHES, in which documents with a similarity of need
    per cent agree but for a probability below MISS."""
    p = (need / 100) ** WIDTH
    for m in range(MATCHES, 0, -1):
        if sum(math.comb(COORDINATES, k) * p ** k * (1 - p) ** (COORDINATES - k) for k in range(m)) < MISS:
            return m
    raise ValueError(f"{COORDINATES} coordinates are too few for a similarity of {need} per cent")


def shingles(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct shingles."""
    words = text.translate(C.LOWER).split()
    if not words:
        return np.zeros(0, dtype=U)
    h = C.hash_words(words)
    if len(h) >= k:
        return np.unique(C.gram_hashes(h, k))
    return C.gram_hashes(h, len(h)) ^ U(len(h))


def signature(s: np.ndarray) -> np.ndarray:
    low = np.full(len(SEEDS), U(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(s), 2048):
        low = np.minimum(low, ((s[at:at + 2048, None] * SEEDS[None, :]) >> U(16)).min(axis=0))
    out = np.arange(1, COORDINATES + 1, dtype=U)
    for j in range(WIDTH):
        out = out * C.P1 + low[j::WIDTH]
    return C.mix(out)


def sign(batches, k: int = SHINGLE):
    for row in C.rows_of(batches):
        chunk = C.Chunk(row)
        out = []
        for d, text in enumerate(chunk.texts()):
            s = shingles(text, k)
            out.append((int(chunk.ids[d]) if chunk.known[d] else None, row["chunk"], d, len(s),
                        hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None,
                        signature(s).tobytes() if len(s) else None))
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(),
                                                   pa.binary(), pa.binary()))],
            names=["doc_id", "chunk", "doc", "n", "set_key", "coordinates"])


def post(batches, matches: int = MATCHES):
    """(key, rep) for the prefix coordinates."""
    prefix = COORDINATES - matches + 1
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64).reshape(-1, COORDINATES)
        reps = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(flat[:, :prefix].ravel()), pa.array(np.repeat(reps, prefix))],
                                         names=["key", "rep"])


def groups(batches, keys: int):
    """Rows of consecutive equal keys (the first ``keys`` columns, int64) out of sorted
    batches: column arrays of one group at a time. Groups span batches."""
    held: list = []

    def take(parts):
        return [pa.chunked_array([p.column(i) for p in parts]).combine_chunks() for i in range(parts[0].num_columns)]

    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            part = batch.slice(a, b - a)
            if held and any(held[-1].column(i)[0] != part.column(i)[0] for i in range(keys)):
                yield take(held)
                held = []
            held.append(part)
    if held:
        yield take(held)


def list_pairs(batches, matches: int = MATCHES):
    """Per list a spanning forest of the pairs that agree in ``matches`` coordinates.
    In: key, rep, bytes (the low byte of each coordinate), sorted by key."""
    us, vs = [], []
    for key, reps, marks in groups(batches, 1):
        reps = reps.to_numpy()
        sig = np.frombuffer(b"".join(marks.to_pylist()), dtype=np.uint8).reshape(len(reps), -1)
        rest = np.arange(len(reps))
        while len(rest) > 1:
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                x = front.pop()
                met = (sig[rest] == sig[x]).sum(axis=1) >= matches
                if met.any():
                    us += [int(reps[x])] * int(met.sum())
                    vs += reps[rest[met]].tolist()
                    front += rest[met].tolist()
                    rest = rest[~met]
        if len(us) > 50_000:
            yield pairs(us, vs)
            us, vs = [], []
    yield pairs(us, vs)


def pairs(us: list, vs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def family_sets(batches, k: int = SHINGLE):
    """The full sets of a chunk's documents that belong to families."""
    for row in C.rows_of(batches):
        chunk = C.Chunk(row)
        out = []
        for m in row["members"]:
            a, b = int(chunk.starts[m["doc"]]), int(chunk.ends[m["doc"]])
            out.append((m["family"], m["rep"], m["blocks"], shingles(chunk.data[a:b], k).tobytes()))
        for i in range(0, len(out), 256):
            cols = list(zip(*out[i:i + 256]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["family", "rep", "blocks", "set"])


def family_links(batches, need: int = NEED):
    """Per (family, block pair) a spanning forest of the true links.
    In: family, pair, rep, set; sorted by family and pair."""
    us, vs = [], []
    for _, _, reps, sets in groups(batches, 2):
        reps = reps.to_numpy()
        raw = sets.to_pylist()
        size = np.array([len(s) // 8 for s in raw])
        _, flat = np.unique(np.frombuffer(b"".join(raw), dtype=U), return_inverse=True)
        flat = flat.astype(np.int32)
        starts = np.cumsum(size) - size
        mark = np.zeros(int(flat.max()) + 1, dtype=np.uint8)
        order = np.argsort(size, kind="stable")
        rest = order
        while len(rest) > 1:
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                x = front.pop()
                near = rest[(100 * np.minimum(size[rest], size[x]) >= need * np.maximum(size[rest], size[x]))]
                if not len(near):
                    continue
                own = flat[starts[x]:starts[x] + size[x]]
                mark[own] = 1
                if len(near) * 4 > len(size):
                    common = np.add.reduceat(mark[flat], starts, dtype=np.int64)[near]
                else:
                    common = np.array([int(mark[flat[starts[y]:starts[y] + size[y]]].sum(dtype=np.int64))
                                       for y in near.tolist()])
                mark[own] = 0
                met = near[100 * common >= need * (size[near] + size[x] - common)]
                if len(met):
                    us += [int(reps[x])] * len(met)
                    vs += reps[met].tolist()
                    front += met.tolist()
                    rest = rest[~np.isin(rest, met)]
        if len(us) > 50_000:
            yield pairs(us, vs)
            us, vs = [], []
    yield pairs(us, vs)


def components(s: C.Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(node, label): label = smallest node of the connected component."""
    both = s.table(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
                   .unionByName(edges.select(F.col("v").alias("a"), F.col("u").alias("b"))).distinct(), f"{name}-edges")
    labels = s.table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                     .withColumnRenamed("a", "node"), f"{name}-0")
    for i in range(1, 100):
        told = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("heard")))
        low = (labels.join(told, labels.node == told.a)
               .select("node", F.least("label", "heard").alias("low"), F.col("label").alias("old")))
        up = labels.select(F.col("node").alias("via"), F.col("label").alias("higher"))
        new = s.table(low.join(up, F.col("low") == F.col("via"))
                      .select("node", F.least("low", "higher").alias("label"), "old"), f"{name}-{i}")
        labels = new.select("node", "label")
        if new.where("label < old").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return labels


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, need: int = NEED,
                    chunks: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept. ``chunks``: the chunk
    table of docs, if there is one already."""
    matches = matches_for(need)
    s = C.Scratch(docs.sparkSession, "minhash")
    chunks = C.chunk_table(s, docs) if chunks is None else chunks
    signed = s.table(chunks.mapInArrow(lambda b: sign(b, shingle), SIGNATURES), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND n > 0")
    reps = s.table(usable.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "chunk", "doc", "n", "coordinates")).alias("r"))
        .select("set_key", F.col("r.doc_id").alias("rep"), "r.chunk", "r.doc", "r.n", "r.coordinates"), "reps")

    posts = s.table(reps.select("rep", "coordinates").mapInArrow(lambda b: post(b, matches), "key long, rep long"), "posts")
    lists = posts.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("first")).where("size > 1")
    met = s.table(posts.join(lists, "key"), "lists")
    star = met.where(f"size > {LIST} AND rep <> first").select(F.col("first").alias("u"), F.col("rep").alias("v"))
    marks = reps.select("rep", F.col("coordinates"))
    counted = (met.where(f"size <= {LIST}").select("key", "rep").join(marks, "rep")
               .mapInArrow(low_bytes, "key long, rep long, marks binary")
               .repartition("key").sortWithinPartitions("key", "rep")
               .mapInArrow(lambda b: list_pairs(b, matches), "u long, v long"))
    family = components(s, counted.unionByName(star).distinct(), "families")

    # blocks of bounded size: a family of more shingles meets in all pairs of blocks
    member = reps.join(family.withColumnRenamed("node", "rep"), "rep").withColumnRenamed("label", "family")
    size = member.groupBy("family").agg(F.ceil(F.sum("n") / BLOCK).cast("long").alias("blocks"))
    wanted = (member.join(size, "family").groupBy("chunk")
              .agg(F.collect_list(F.struct("doc", "rep", "family", "blocks")).alias("members")))
    sets = chunks.join(wanted, "chunk").mapInArrow(
        lambda b: family_sets(b, shingle), "family long, rep long, blocks long, set binary")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    spread = (sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .where("blocks = 1 OR own <> other")
              .withColumn("pair", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")))
    links = (spread.select("family", "pair", "rep", "set").repartition("family", "pair")
             .sortWithinPartitions("family", "pair", "rep").mapInArrow(lambda b: family_links(b, need), "u long, v long"))
    label = components(s, links, "components")
    of_set = (reps.select("set_key", "rep").join(label, reps.rep == label.node, "left")
              .select("set_key", F.coalesce("label", "rep").alias("component")))
    out = (signed.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
           .join(of_set, "set_key", "left"))
    return s.result(out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def low_bytes(batches):
    """(key, rep, coordinates) -> the low byte of each coordinate."""
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("coordinates").to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES, 8)
        small = np.ascontiguousarray(flat[:, :, 0]).tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("rep"),
             pa.array([small[i:i + COORDINATES] for i in range(0, len(small), COORDINATES)], pa.binary())],
            names=["key", "rep", "marks"])


def brute_force(docs: list, shingle: int = SHINGLE, need: int = NEED) -> dict:
    """docs: (id, text) with distinct ids. {id: (set size, smallest id reachable)}, all pairs."""
    sets = {}
    for i, t in docs:
        w = (t or "").encode().translate(C.LOWER).split()
        sets[i] = {tuple(w[j:j + shingle]) for j in range(max(1, len(w) - shingle + 1))} if w else set()
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if a < b and sets[a] and sets[b] and label[a] != label[b] and \
                        100 * len(sets[a] & sets[b]) >= need * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}
