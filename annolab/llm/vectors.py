"""Near-duplicate vectors by an exact metric range join.

Two vectors of a label are linked if their cosine is at least ``least``; for unit vectors
that is a distance of at most r = sqrt(2 - 2 * least). Equal vectors are one row with a weight
from the start.

1. Cells. The vectors of a label are a cell. A cell of more than ``cell`` vectors is divided by
   pivots drawn from it: the cell of its nearest pivot is a vector's home, and it is copied to
   every other cell in which a vector within r of it may be at home. The triangle inequality
   bounds that: if u is at home with pivot j and |uv| <= r, v lies at most r behind the
   plane halfway between j and its own nearest pivot i, i.e. |vj|^2 - |vi|^2 <= 2 r |ij| (which
   implies |vj| <= |vi| + 2 r). Cells that are still too large are divided again, unless a
   sample says that more than half of the new cells would get a copy of everything.
2. Balls. Vectors within r / 2 of one point are all linked, which needs no comparison. Where the
   sample of a cell shows such a ball that holds an eighth of it, the ball leaves the cell; only
   what lies within 3/2 r of the point is compared with its members. Thousands of near
   copies, or a third of all rows, so cost a pass and not a square.
3. Join. Every cell is joined by itself: a block of its home vectors meets the cell's vectors as a
   stream. All links of a vector are counted in its home cell (and ball); of the links
   themselves only enough to connect what is connected are sent on, so groups stay linear.
4. Connected components of these links, then back to the rows.

What a task holds: a block of home vectors, a batch of the stream and their product; or the
pivots of a cell. Vectors without structure (evenly spread in many dimensions) get copied to
most cells of the first division and are then left alone: no exact method prunes them.

Defined cases: vectors that are NULL, empty, zero or hold a NULL or non-finite component, and
rows with a NULL label or NULL id, link with nothing (n_links 0, component_id = vec_id,
kept true); vectors of different length never link; rows that repeat an id are vectors of
their own; component_id is the smallest id reachable, so ties can't occur; other columns are
left out; an empty table gives no rows.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolab.llm.common import Scratch, ship
from annolab.llm.minhash import components

LEAST = 0.98
CELL = 512                 # home vectors of a cell that is not divided
PIVOTS = 8                 # pivots of a division
SAMPLE = 256               # vectors drawn (expected) to plan a division
BLOCK = 4096               # home vectors a task holds
STREAM = 512               # streamed vectors compared at once
SALT = 1 << 16             # rows of a cell that one task deals out
ROUNDS = 12
SLACK = 1e-9               # of distances, against rounding

MEMBER = "cell string, rep long, weight long, home boolean, raw binary"
MEET = "unit string, kind int, rep long, weight long, home boolean, raw binary"
FOUND = "u long, v long, n long"


# ------------------------------------------------------------------ rows
def prepared(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, cell, raw): cell is NULL for rows that link with nothing; raw are the
    components, as ``width_of`` says."""
    kind = width_of(df, vec_col)
    base = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                     F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    v = F.col("v")
    ok = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0)
          & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0))
    base = base.select("vec_id", F.when(ok, F.concat_ws(":", F.size(v), "label")).alias("cell"), F.when(ok, v).alias("v"))

    def pack(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0     # -0.0 becomes 0.0
            ends = np.cumsum([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()]).tolist()
            raw = [flat[a:b].tobytes() if b > a else None for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())],
                                             names=["vec_id", "cell", "raw"])

    return base.mapInArrow(pack, "vec_id long, cell string, raw binary")


def width_of(df: DataFrame, vec_col: str) -> str:
    """Floats travel as floats, everything else as doubles; all arithmetic is in doubles."""
    return "f4" if df.schema[vec_col].dataType.simpleString() == "array<float>" else "f8"


def unit_rows(column, kind: str) -> np.ndarray:
    """Unit vectors of a binary column of equally long rows."""
    m = np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1).astype(np.float64)
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T))


def sections(batches):
    """(unit, kind, part of a batch) of rows that are sorted by unit and kind."""
    for batch in batches:
        unit, kind = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        for i in range(1, batch.num_rows + 1):
            if i == batch.num_rows or unit[i] != unit[at] or kind[i] != kind[at]:
                yield unit[at], kind[at], batch.slice(at, i - at)
                at = i


def meet(first: DataFrame, then: DataFrame, run, schema: str) -> DataFrame:
    """Bring rows of a unit together, those of ``first`` before those of ``then``, as streams."""
    return (first.unionByName(then).repartition("unit").sortWithinPartitions("unit", "kind").mapInArrow(run, schema))


# ------------------------------------------------------------------ cells
def reached(d2: np.ndarray, between: np.ndarray, r: float) -> np.ndarray:
    """Which pivots' cells a vector with these squared distances belongs or is copied to."""
    near = d2.argmin(1)
    rows = np.arange(len(d2))
    out = d2 - d2[rows, near][:, None] <= 2 * r * between[near] + SLACK
    out[rows, near] = True
    return out


def plan(pivots: int, r: float, width: str):
    """Of a cell's sample: pivots (none if a division would not help) and the middle of a ball
    (none if there is none)."""
    def run(table):
        table = table.sort_by([("draw", "ascending"), ("rep", "ascending")])
        x, first = unit_rows(table.column("raw"), width), table.column("first")[0].as_py()
        d2 = squares(x, x)
        best = int((d2 <= r * r).sum(1).argmax())
        middle = x[d2[best] <= r * r].mean(0)
        inside = squares(x, middle[None])[:, 0] <= (r / 2) ** 2
        ball = middle if inside.sum() * 8 >= len(x) and inside.sum() > 1 else np.zeros(0)
        rest = x[~inside] if len(ball) else x
        p = rest[:pivots]
        if len(p) > 1 and not first:
            between = np.sqrt(squares(p, p))
            if reached(squares(rest, p), between, r).sum(1).mean() > max(2.0, len(p) / 2):
                p = p[:0]
        out = io.BytesIO()
        np.savez(out, pivots=p if len(p) > 1 else np.zeros((0, x.shape[1])), ball=ball)
        return pa.table({"cell": [table.column("cell")[0].as_py()], "raw": pa.array([out.getvalue()], pa.binary())})
    return run


def deal(r: float, width: str):
    """Rows of a divided cell -> rows of its parts. Parts: cell/0 .. cell/n by pivot, cell/= if it
    is not divided, cell/* for the members of its ball (home) and what may be linked with them."""
    def run(batches):
        pivots = ball = between = None
        for unit, kind, part in sections(batches):
            cell = unit.rsplit("#", 1)[0]
            if kind == 0:
                got = np.load(io.BytesIO(part.column("raw")[0].as_py()))
                pivots, ball = got["pivots"], got["ball"]
                between = np.sqrt(squares(pivots, pivots))
                continue
            for at in range(0, part.num_rows, 2048):
                rows = part.slice(at, 2048)
                x, home = unit_rows(rows.column("raw"), width), rows.column("home").to_numpy(zero_copy_only=False).astype(bool)
                left = np.ones(len(x), dtype=bool)
                if len(ball):
                    d = np.sqrt(squares(x, ball[None])[:, 0])
                    left = ~(home & (d <= r / 2 - SLACK))
                    yield _members(rows, ~left, cell + "/*", None)
                    yield _members(rows, left & (d <= 1.5 * r + SLACK), cell + "/*v", home)
                if not len(pivots):
                    yield _members(rows, left, cell + "/=", home)
                    continue
                d2 = squares(x, pivots)
                to = reached(d2, between, r) & left[:, None]
                near = d2.argmin(1)
                for j in range(len(pivots)):
                    yield _members(rows, to[:, j], f"{cell}/{j}", home & (near == j))
    return run


def _members(rows, mask: np.ndarray, cell: str, home) -> pa.RecordBatch:
    at = pa.array(np.flatnonzero(mask))
    n = len(at)
    return pa.RecordBatch.from_arrays(
        [pa.array([cell] * n, pa.string()), rows.column("rep").take(at), rows.column("weight").take(at),
         pa.array(np.ones(n, dtype=bool) if home is None else home[mask], pa.bool_()), rows.column("raw").take(at)],
        names=["cell", "rep", "weight", "home", "raw"])


def cells(s: Scratch, reps: DataFrame, r: float, width: str, cell: int, pivots: int, sample: int) -> tuple[DataFrame, DataFrame]:
    """(rows of cells to be joined, rows of balls), both of MEMBER."""
    open_, done, balls = reps, [], []
    for i in range(ROUNDS):
        sizes = s.table(open_.groupBy("cell").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("total")),
                        f"sizes-{i}")
        sized = open_.join(sizes, "cell")
        small = (F.col("homes") <= cell) | F.col("cell").endswith("/=") if i else F.col("homes") <= cell
        done.append(sized.where(small).drop("homes", "total"))
        large = sizes.where(~small)
        if large.isEmpty():
            break
        todo = sized.where(~small)
        draw = F.pmod(F.xxhash64("rep", F.lit(i)), F.lit(1 << 40))
        drawn = (todo.where(F.col("home")).withColumn("draw", draw)
                 .where(F.col("draw") < F.lit(float(1 << 40)) * sample / F.col("homes"))
                 .select("cell", "rep", "raw", "draw", F.lit(i == 0).alias("first")))
        plans = s.table(drawn.groupBy("cell").applyInArrow(plan(pivots, r, width), "cell string, raw binary"), f"plans-{i}")
        salts = F.ceil(F.col("total") / SALT)
        salted = F.concat_ws("#", "cell", F.pmod(F.xxhash64("rep"), salts))
        heads = (large.join(plans, "cell")
                 .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
                 .select(F.concat_ws("#", "cell", "salt").alias("unit"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("rep"),
                         F.lit(0).cast("long").alias("weight"), F.lit(False).alias("home"), "raw"))
        planned = todo.join(plans.select("cell"), "cell", "left_semi")
        done.append(todo.join(plans.select("cell"), "cell", "left_anti").drop("homes", "total"))   # none was drawn
        dealt = s.table(meet(heads, planned.select(salted.alias("unit"), F.lit(1).alias("kind"), "rep", "weight", "home", "raw"),
                             deal(r, width), MEMBER), f"dealt-{i}")
        in_ball = F.col("cell").rlike(r"/\*v?$")
        balls.append(dealt.where(in_ball))
        open_ = dealt.where(~in_ball)
    else:
        done.append(open_)
    return _union(done), _union(balls or [reps.limit(0)])


def _union(parts: list) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ join
def blocks(homes: DataFrame, stream: DataFrame, block: int, kind: int) -> tuple[DataFrame, DataFrame]:
    """(home rows, stream rows) as rows of MEET: a unit is a block of a cell's home rows."""
    count = homes.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = homes.join(count, "cell").withColumn("b", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    other = stream.join(count, "cell").withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return tuple(x.select(F.concat_ws("#", "cell", "b").alias("unit"), F.lit(k).alias("kind"), "rep", "weight", "home", "raw")
                 for x, k in ((own, kind), (other, kind + 1)))


class Block:
    """Home vectors of a unit, their counts, and which of them are connected so far."""

    def __init__(self, x, rep, weight, counted):
        self.x, self.rep, self.weight, self.counted = x, rep, weight, counted
        self.n = np.zeros(len(rep), dtype=np.int64)
        self.root = np.arange(len(rep))

    def stream(self, x, rep, weight, least: float, both: bool):
        """Compare; returns (edges u, edges v, counts of the streamed vectors or None)."""
        hit = self.x @ x.T >= least
        self.n += hit @ weight
        theirs = self.weight @ hit if both else None
        other = hit & (self.rep[:, None] != rep[None]) if not both else hit
        cols = np.flatnonzero(other.any(0))
        if not len(cols):
            return rep[:0], rep[:0], theirs
        rows = np.flatnonzero(other.any(1))
        link = hit[np.ix_(rows, cols)]
        big = len(self.rep)
        root = self.root
        while True:                                        # smallest root over links, until settled
            low = np.where(link, root[rows][:, None], big).min(0)
            back = np.minimum(root[rows], np.where(link, low[None], big).min(1))
            if np.array_equal(back, root[rows]):
                break
            moved = root.copy()
            np.minimum.at(moved, root[rows], back)         # the old root follows, too
            moved[rows] = np.minimum(moved[rows], back)
            while not np.array_equal(moved[moved], moved):
                moved = moved[moved]
            root = moved[root]
        self.root = root
        u, v = self.rep[low], rep[cols]
        return u[u != v], v[u != v], theirs

    def rest(self):
        """Edges between the home vectors that are connected, and the counts."""
        u = self.rep[self.root]
        on = u != self.rep
        return u[on], self.rep[on], self.rep[self.counted], self.n[self.counted]


def _found(u, v, n) -> pa.RecordBatch:
    none = lambda x, like: pa.nulls(len(like), pa.int64()) if x is None else pa.array(x, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), none(v, u), none(n, u)], names=["u", "v", "n"])


def join_units(least: float, width: str):
    """Rows of FOUND: edges (u, v) and counts (u, n)."""
    def run(batches):
        block, at, held = None, None, []

        def closed():
            if block is not None:
                u, v, rep, n = block.rest()
                yield _found(u, v, None)
                yield _found(rep, None, n)

        for unit, kind, part in sections(batches):
            if unit != at:
                yield from closed()
                at, block, held = unit, None, []
            if kind % 2 == 0:
                held.append(part)
                continue
            if block is None:
                if not held:
                    continue
                rows = pa.Table.from_batches(held)
                block = Block(unit_rows(rows.column("raw"), width), rows.column("rep").to_numpy(), rows.column("weight").to_numpy(),
                              rows.column("home").to_numpy().astype(bool))
                held = []
            for i in range(0, part.num_rows, STREAM):
                rows = part.slice(i, STREAM)
                rep = rows.column("rep").to_numpy()
                u, v, theirs = block.stream(unit_rows(rows.column("raw"), width), rep, rows.column("weight").to_numpy(),
                                            least, kind == 3)
                if len(u):
                    yield _found(u, v, None)
                if theirs is not None:
                    yield _found(rep, None, theirs)
        yield from closed()
    return run


def near_vectors(df: DataFrame, least: float = LEAST, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", cell: int = CELL, pivots: int = PIVOTS, sample: int = SAMPLE,
                 block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    ship(df.sparkSession)
    s = Scratch(df.sparkSession, "vectors")
    r, width = float(np.sqrt(2 - 2 * least)), width_of(df, vec_col)
    rows = s.table(prepared(df, id_col, vec_col, label_col), "rows")
    reps = s.table(rows.where("cell IS NOT NULL").groupBy("cell", "raw")
                   .agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
                   .select("cell", F.col("rep"), "weight", F.lit(True).alias("home"), "raw",
                           F.md5(F.concat(F.col("cell").cast("binary"), F.col("raw"))).alias("key")), "reps")
    joined, ball = cells(s, reps.drop("key"), r, width, cell, pivots, sample)
    near = ball.where(F.col("cell").endswith("v")).withColumn("cell", F.expr("left(cell, length(cell) - 1)"))
    members = ball.where(~F.col("cell").endswith("v"))
    first, stream = blocks(joined.where("home"), joined, block, 0)
    first2, stream2 = blocks(near, members, block, 2)
    found = s.table(meet(first.unionByName(first2), stream.unionByName(stream2), join_units(least, width), FOUND), "found")
    whole = (members.groupBy("cell").agg(F.sum("weight").alias("n"), F.min("rep").alias("u")))
    within = members.select("cell", "rep").join(whole, "cell")
    edges = (found.where("v IS NOT NULL").select("u", "v")
             .unionByName(within.where("u <> rep").select("u", F.col("rep").alias("v"))).distinct())
    counts = (found.where("v IS NULL").select(F.col("u").alias("rep"), "n").unionByName(within.select("rep", "n"))
              .groupBy("rep").agg(F.sum("n").alias("n")))
    label = components(s, edges, "components")
    of_rep = (reps.select("rep", "key").join(counts, "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left")
              .select("key", F.col("n"), F.coalesce("label", "rep").alias("component")))
    out = (rows.select("vec_id", F.md5(F.concat(F.col("cell").cast("binary"), F.col("raw"))).alias("key"))
           .join(of_rep, "key", "left")
           .select("vec_id", F.coalesce(F.col("n") - 1, F.lit(0).cast("long")).alias("n_links"),
                   F.coalesce("component", "vec_id").alias("component_id")))
    return s.result(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def brute_force(rows: list, least: float = LEAST) -> list:
    """rows: (vec_id, vector, label). [(vec_id, n_links, component_id, kept)], all pairs."""
    def good(i, v, g):
        return (i is not None and g is not None and v and all(x is not None and np.isfinite(x) for x in v)
                and any(x != 0 for x in v))

    def unit_vector(v):
        x = np.array(v, dtype=np.float64) / max(abs(c) for c in v)
        return x / np.linalg.norm(x)

    unit = [unit_vector(v) if good(i, v, g) else None for i, v, g in rows]
    links: list = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] \
                    and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= least:
                links[a].append(b)
    low = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for a, to in enumerate(links):
            for b in to:
                if low[b] < low[a]:
                    low[a], changed = low[b], True
    return [(r[0], len(links[a]), low[a], True if r[0] is None else r[0] == low[a]) for a, r in enumerate(rows)]
