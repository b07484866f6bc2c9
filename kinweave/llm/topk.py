"""Exact top-k by inner product with a pivot table.

Distances of every vector to a set of pivots are computed once and written. They give a
lower bound of the distance of a query and a candidate (the largest difference of their
distances to a pivot), and with the norms an upper bound of the inner product. A query first
meets a block of its nearest pivot's cell; the k-th score found there excludes whole cells,
before anything is shuffled to them, and then candidates of the other blocks, which are
evaluated in order of their bounds until the next bound is below the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging

#: Pivots of a length of vectors (the origin is one of them), chosen among this many vectors.
PIVOTS, SAMPLE = 32, 64
#: Lengths of vectors that get pivots, the most frequent ones; others are searched without bounds.
LENGTHS = 16
#: Vectors of a candidate block, and queries of a query block: what a task holds at a time.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
#: Candidates evaluated at a time.
STEP = 256
#: Pairs of query and candidate blocks that are broadcast at most.
SMALL_PAIRS = 200_000


def search_block(q_ids: np.ndarray, q: np.ndarray, q_far: np.ndarray, least: np.ndarray, ids: np.ndarray, x: np.ndarray, x_far: np.ndarray, k: int) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], int]:
    """Position of each query with scores and ids of its k best candidates of one block, ties to smaller ids, and how many pairs were evaluated.

    Candidates of a query's own id or of a score below its ``least`` are left out. Where bounds
    leave over a quarter of a block to a query, its scores are one row of a matrix product.
    Scores are exact: in 32-bit or 64-bit floats where products of norms leave room for it, else
    in 64-bit integers; pairs whose scores might not fit these raise an error.
    """
    order = np.argsort(ids, kind="stable")
    ids, x, far = ids[order], x[order], np.ascontiguousarray(x_far[order].T)
    norms, q_norms = ((v.astype(float) ** 2).sum(1) for v in (x, q))
    most = norms.max() * q_norms.max()
    if most >= 2.0**124:
        raise OverflowError("inner products of these vectors may not fit 64 bits")
    kind = np.float32 if most < 2.0**48 else np.float64 if most < 2.0**106 else np.int64
    x, q = x.astype(kind), q.astype(kind)
    # Distances are stored as 32-bit floats.
    slack = 1e-6 * max(far.max(initial=0), q_far.max(initial=0))
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    evaluated, rows = 0, max(1, 65536 // len(ids))

    def better(best: tuple, some: np.ndarray, scores: np.ndarray, i: int) -> tuple:
        fine = (ids[some] != q_ids[i]) & (scores >= least[i])
        s, found = np.concatenate([best[0], scores[fine]]), np.concatenate([best[1], ids[some[fine]]])
        top = np.lexsort((found, -s))[:k]
        return s[top], found[top]

    for at in range(0, len(q), rows):
        apart = np.zeros((len(q[at : at + rows]), len(ids)), np.float32)
        for p in range(len(far)):
            np.maximum(apart, np.abs(far[p] - q_far[at : at + rows, p, None]), out=apart)
        both = q_norms[at : at + rows, None] + norms
        bounds = (both - np.maximum(apart - slack, 0) ** 2) / 2 + 1e-6 * (both + 1) if len(far) else np.full(apart.shape, np.inf)
        whole = []
        for j, bound in enumerate(bounds):
            i = at + j
            best, floor = (np.empty(0, kind), np.empty(0, np.int64)), least[i]
            todo = np.flatnonzero(bound >= floor)
            if 4 * len(todo) > len(ids) > STEP:
                if np.isinf(floor):
                    first = np.argpartition(-bound, STEP)[:STEP]
                    s = better(best, first, x[first] @ q[i], i)[0]
                    evaluated += STEP
                    floor = s[-1] if len(s) == k else floor
                    todo = np.flatnonzero(bound >= floor)
                if 4 * len(todo) > len(ids):
                    whole.append((j, floor))
                    continue
            todo = todo[np.argsort(-bound[todo], kind="stable")]
            for a in range(0, len(todo), STEP):
                if len(best[0]) == k and bound[todo[a]] < best[0][-1]:
                    break
                some = todo[a : a + STEP]
                best = better(best, some, x[some] @ q[i], i)
                evaluated += len(some)
            out.append((i, *best))
        if whole:
            evaluated += len(whole) * len(ids)
            for (j, floor), scores in zip(whole, q[[at + j for j, _ in whole]] @ x.T, strict=True):
                some = np.flatnonzero(scores >= floor)
                out.append((at + j, *better((np.empty(0, kind), np.empty(0, np.int64)), some, scores[some], at + j)))
    return out, evaluated


def quantized(vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component; null ids and vectors that are null or hold null, NaN or infinity go.

    A component beyond 2**62 after scaling is an error: no score with it fits 64 bits.
    """
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    whole = lambda x: F.when(F.abs(x * scale) > 2.0**62, F.raise_error(F.lit("a component is beyond 2**62: scores don't fit 64 bits")).cast("long")).otherwise(F.floor(x * scale).cast("long"))
    return rows.select("vec_id", F.transform("v", whole).alias("v"))


def choose_pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each frequent length: the vectors of a hash sample that lie farthest from those before, then the origin."""
    h = F.xxhash64("vec_id")
    lists = rows.groupBy("dim", F.pmod(h, F.lit(SAMPLE)).alias("b")).agg(F.count("*").alias("n"), F.min(h).alias("h")).groupBy("dim").agg(F.sum("n").alias("n"), F.collect_list("h").alias("hs"))
    found = lists.orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
    sample = rows.filter(F.col("dim").isin([r.dim for r in found]) & h.isin([x for r in found for x in r.hs])).groupBy("dim", h.alias("h")).agg(F.min("v").alias("v")).orderBy("dim", "h").collect()
    out = {}
    for r in found:
        x = np.array([s.v for s in sample if s.dim == r.dim], float)
        picked, near = [0], ((x - x[0]) ** 2).sum(1)
        while len(picked) < min(PIVOTS - 1, len(x)) and near.max() > 0:
            picked.append(int(near.argmax()))
            near = np.minimum(near, ((x - x[picked[-1]]) ** 2).sum(1))
        out[r.dim] = np.vstack([x[picked], np.zeros((1, x.shape[1]))])
    return out


def pivot_table(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with ``far`` (distances to pivots), ``cell`` (nearest pivot but the origin) and ``nth`` (number of the row in its task)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                p = pivots.get(dim, np.empty((0, dim)))
                v = np.stack(part["v"].to_numpy()).astype(float)
                far = np.sqrt(np.maximum((v * v).sum(1)[:, None] + (p * p).sum(1) - 2 * v @ p.T, 0))
                cell = far[:, :-1].argmin(1) if len(p) else 0
                yield part.assign(far=list(far.astype(np.float32)), cell=cell, nth=np.arange(n, n + len(part)))
                n += len(part)

    return rows.mapInPandas(run, "dim int, vec_id long, v array<long>, far array<float>, cell int, nth long")


def cells_of(rows: DataFrame, pivots: dict[int, np.ndarray]) -> list:
    """Rows of each cell with the range of their distances to each pivot; lengths without pivots are one cell of length -1."""
    ranges = [F.array(*[f(F.get("far", F.lit(i))) for i in range(PIVOTS)]).alias(name) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    return rows.groupBy(_length(pivots).alias("length"), "cell").agg(F.count("*").alias("n"), *ranges).collect()


def _length(pivots: dict[int, np.ndarray]) -> Column:
    return F.when(F.col("dim").isin(list(pivots)), F.col("dim")).otherwise(-1)


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k largest inner products of each query with other ids.

    Both tables have ``vec_id, v`` (arrays of integers of one length for each pair; a pair of
    different lengths has no score). Queries and candidates meet block by block, so a task
    holds one block of each, whatever the size of the tables or of a cell; only blocks of
    cells that a query's bounds don't exclude meet it. Repeated rows of ``vectors`` count
    once each, those of ``queries`` once. The driver holds pivots and the ranges of their cells.
    """
    spark, stage = vectors.sparkSession, Staging(vectors.sparkSession, "topk")
    rows = vectors.select(F.size("v").alias("dim"), "vec_id", "v")
    pivots = choose_pivots(rows)
    x = stage.write(pivot_table(rows, pivots), "vectors")
    q = stage.write(pivot_table(queries.select(F.size("v").alias("dim"), "vec_id", "v").distinct(), pivots), "queries")
    cells, asked = cells_of(x, pivots), cells_of(q, pivots)
    blocks = [(r.length, r.cell, -(-r.n // BLOCK_ROWS)) for r in cells]
    parts = [(r.length, r.cell, -(-r.n // BLOCK_QUERIES)) for r in asked]
    # Small cells share a group of queries, large ones have several.
    groups, filled = [], BLOCK_QUERIES
    for r, (length, cell, n) in zip(asked, parts, strict=True):
        fits = n == 1 and filled + r.n <= BLOCK_QUERIES
        at = groups[-1][2] if fits else groups[-1][2] + last if groups else 0
        filled, last = (filled if fits else 0) + r.n, n
        groups.append((length, cell, at))
    known = {d: [r for r in cells if r.length == d] for d in pivots}
    reach = {d: (np.array([r.cell for r in c], int), *(np.array([getattr(r, f)[: len(pivots[d])] for r in c], float) for f in ("lo", "hi"))) for d, c in known.items()}

    small = lambda found, name: F.broadcast(spark.createDataFrame(found, f"length int, cell int, {name} long"))
    dealt = lambda df, found, own: df.withColumn("length", _length(pivots)).join(small(found, own + "s"), ["length", "cell"]).withColumn(own, F.pmod(F.xxhash64("vec_id", "nth"), F.col(own + "s")))
    q = dealt(q, parts, "part").drop("nth", "parts")
    x = dealt(x, blocks, "block").drop("nth", "blocks")
    matrix = lambda column, kind=float: np.stack(column.to_numpy()).astype(kind)

    def search(q: pd.DataFrame, x: pd.DataFrame, least: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        if not len(q) or not len(x):
            return []
        return search_block(q["vec_id"].to_numpy(), matrix(q["v"], np.int64), matrix(q["far"], np.float32), least, x["vec_id"].to_numpy(), matrix(x["v"], np.int64), matrix(x["far"], np.float32), k)[0]

    def at_home(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        """Each query with its best of one block, its k-th score there and the cells that may hold as good ones."""
        least, ids, scores = np.full(len(q), -np.inf), [[]] * len(q), [[]] * len(q)
        for i, s, found in search(q, x, least.copy()):
            ids[i], scores[i] = found, s.astype(np.int64)
            # A little less, where a float can't hold the score.
            least[i] = float(s[-1]) - abs(float(s[-1])) * 2.0**-52 if len(s) == k else -np.inf
        dim = q["dim"].iloc[0] if len(q) else None
        if dim in reach:
            cell, lo, hi = reach[dim]
            far = matrix(q["far"])[:, None, :]
            apart = np.maximum(lo - far, far - hi).max(2, initial=0)
            apart = np.maximum(apart - 1e-6 * max(hi.max(initial=0), far.max(initial=0)), 0)
            both = far[:, 0, -1:] ** 2 + hi[:, -1] ** 2
            open_cells = [cell[row] for row in (both - apart**2) / 2 + 1e-6 * (both + 1) >= least[:, None]]
        else:
            open_cells = [[0]] * len(q)
        return q[["dim", "length", "cell", "part", "vec_id", "v", "far"]].assign(least=least, **{c: pd.Series(values, q.index, dtype=object) for c, values in (("open", open_cells), ("ids", ids), ("scores", scores))})

    def further(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        found = search(q, x, q["least"].to_numpy())
        ids = q["vec_id"].to_numpy()
        rows = [(ids[i], v, v_score) for i, s, some in found for v, v_score in zip(some, s, strict=True)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    # Each query block meets one block of its own cell.
    key = ["dim", "cell", "part"]
    homes = x.filter("block = 0").drop("block").join(small(parts, "parts"), ["length", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    met = q.groupBy(*key).cogroup(homes.groupBy(*key)).applyInPandas(at_home, "dim int, length int, cell int, part long, vec_id long, v array<long>, far array<float>, least double, open array<int>, ids array<long>, scores array<long>")
    met = stage.write(met, "met")

    # Then the blocks that it can't exclude.
    todo = met.select("dim", "length", F.col("cell").alias("home"), "part", "vec_id", "v", "far", "least", F.explode("open").alias("cell")).join(small(blocks, "blocks"), ["length", "cell"])
    todo = todo.join(small(groups, "group").withColumnRenamed("cell", "home"), ["length", "home"]).withColumn("group", F.col("group") + F.col("part"))
    todo = todo.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).filter("NOT (cell = home AND block = 0)")
    key = ["dim", "group", "cell", "block"]
    wanted = todo.select(*key).distinct().toDF(*key)
    if sum(b[2] for b in blocks) * sum(p[2] for p in parts) <= SMALL_PAIRS and all(b[0] > 0 for b in blocks):
        wanted = F.broadcast(wanted)
    asked_for = x.join(wanted, ["dim", "cell", "block"])
    more = todo.groupBy(*key).cogroup(asked_for.groupBy(*key)).applyInPandas(further, "query_id long, vec_id long, score long")
    near = more.unionByName(met.select(F.col("vec_id").alias("query_id"), F.inline(F.arrays_zip("ids", "scores"))).toDF("query_id", "vec_id", "score"))
    best = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("top"))
    return best.select("query_id", F.posexplode("top").alias("i", "x")).select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
