"""Exact k-means over integer vectors that skips distances by bounds from a history of centroids.

Each vector keeps, for every centroid, the distance it had when last evaluated and the round of
that evaluation. A bound is loosened by the norm of the centroid's whole displacement since
then, read off the retained history: never more, and mostly less, than the sum of its moves
from round to round. A vector whose own loosened upper bound stays below all loosened lower
bounds keeps its centroid; otherwise exactly the failing distances are evaluated again, in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging

#: Components beyond this size would not leave room for sums of their squares.
LARGEST = 1 << 26
#: Bounds are real numbers; this share is added to be on the safe side of rounding.
SLACK = 1e-9
#: Vectors that a task handles at a time.
ROWS = 8192


def quantized(vectors: DataFrame, size: int = 64, scale: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(scale * x) of the vectors with exactly ``size`` components, none of them null, NaN or infinite.

    A component beyond ``LARGEST`` after scaling is an error: squared distances would not fit a long.
    """
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter((F.size("v") == size) & fine)
    whole = lambda x: F.when(F.abs(x * scale) > LARGEST, F.raise_error(F.lit(f"a component is beyond {LARGEST}")).cast("long")).otherwise(F.floor(x * scale).cast("long"))
    return rows.select("vec_id", F.transform("v", whole).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors with the smallest hex SHA-256 of seed and id, in order of the hash; fewer if there are fewer."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    found = rows.select(h.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r.v for r in found], np.int64)


def evaluate(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``x`` to the same row of ``c``, exactly."""
    return ((x - c) ** 2).sum(1)


def assign(x: np.ndarray, history: np.ndarray, cluster: np.ndarray | None, far: np.ndarray | None, seen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroid of the last round of ``history`` (ties to the smaller number), squared distances and rounds at the last evaluation, and how many were evaluated.

    ``history``: rounds x centroids x components. ``far[i, j]`` is the squared distance of
    vector i to centroid j in round ``seen[i, j]``. Without a state every distance is evaluated.
    """
    now, (k, rows) = len(history) - 1, (history.shape[1], np.arange(len(x)))
    if cluster is None:
        far = np.stack([evaluate(x, c) for c in history[now]], 1)
        return far.argmin(1), far, np.full(far.shape, now, np.int8), far.size
    far, seen = far.copy(), seen.copy()
    # moved[t, j]: how far centroid j is from where it was in round t.
    moved = np.sqrt(((history - history[now]).astype(float) ** 2).sum(2)) * (1 + SLACK)
    root = np.sqrt(far.astype(float))
    loose = moved[seen, np.arange(k)]
    low = root * (1 - SLACK) - loose
    high = root[rows, cluster] * (1 + SLACK) + loose[rows, cluster]
    low[rows, cluster] = np.inf
    evaluated = 0

    def measure(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal evaluated
        far[i, j], seen[i, j] = evaluate(x[i], history[now, j]), now
        evaluated += len(i)

    # First the own distance of the vectors whose bounds meet, then the distances that still may be as small.
    open_rows = np.flatnonzero(low.min(1, initial=np.inf) <= high)
    measure(open_rows, cluster[open_rows])
    exact = np.sqrt(far[open_rows, cluster[open_rows]].astype(float)) * (1 + SLACK)
    i, j = np.nonzero(low[open_rows] <= exact[:, None])
    measure(open_rows[i], j)
    fresh = np.where(seen[open_rows] == now, far[open_rows], np.iinfo(np.int64).max)
    out = cluster.copy()
    out[open_rows] = fresh.argmin(1)
    return out, far, seen, evaluated


def _matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32()), pa.array(matrix.ravel(), kind))


def _step(rows: DataFrame, history: np.ndarray, first: bool) -> DataFrame:
    """``rows`` with their state after the last round of ``history``; ``evaluated`` has a batch's number of distances of this round in its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                state = (None,) * 3 if first else (batch["cluster"].to_numpy(), _matrix(batch["far"]), _matrix(batch["seen"]))
                cluster, far, seen, evaluated = assign(_matrix(batch["v"]), history, *state)
                count = np.zeros(len(batch), np.int64)
                count[0] = evaluated
                was = pa.array(np.full(len(batch), -1, np.int32)) if first else batch["cluster"]
                columns = [batch["vec_id"], batch["v"], pa.array(cluster, pa.int32()), was, _lists(far, pa.int64()), _lists(seen, pa.int8()), pa.array(count)]
                yield pa.record_batch(columns, names=["vec_id", "v", "cluster", "was", "far", "seen", "evaluated"])

    return rows.mapInArrow(run, "vec_id long, v array<long>, cluster int, was int, far array<long>, seen array<tinyint>, evaluated long")


def _sums(rows: DataFrame, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How sums and sizes of the clusters change by the vectors that have changed theirs.

    A task sends a row for each cluster and component at most, the driver gets as many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 1), np.int64)
        for batch in batches:
            x = np.hstack([_matrix(batch["v"]), np.ones((batch.num_rows, 1), np.int64)])
            now, was = batch["cluster"].to_numpy(), batch["was"].to_numpy()
            np.add.at(total, now, x)
            np.subtract.at(total, was[was >= 0], x[was >= 0])
        j, i = np.nonzero(total)
        yield pa.record_batch({"j": pa.array(j, pa.int32()), "i": pa.array(i, pa.int32()), "s": pa.array(total[j, i], pa.int64())})

    out = np.zeros((k, size + 1), np.int64)
    for r in rows.filter("cluster != was").select("v", "cluster", "was").mapInArrow(run, "j int, i int, s long").groupBy("j", "i").agg(F.sum("s").alias("s")).collect():
        out[r.j, r.i] = r.s
    return out[:, :size], out[:, size]


def kmeans(rows: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, v, cluster, distance, evaluated`` of each row after ``rounds`` updates and one more assignment, and the last centroids.

    ``rows``: ``vec_id, v`` with integers of one length. A centroid becomes the floor of the
    mean of its vectors; one without vectors stays. Repeated rows count one by one; a null id is a
    vector like any other and becomes a first centroid last. Each round writes vectors and
    state to the shared folder and deletes those of the round before; the driver holds the
    history of centroids, which grows with ``k`` and ``rounds`` only.
    """
    stage = Staging(rows.sparkSession, "kmeans")
    state = stage.write(rows.select("vec_id", "v"), "vectors")
    centroids = first_centroids(state, k, seed)
    if not len(centroids):
        return state.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("evaluated")), centroids
    history = [centroids]
    sums, sizes = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
    for t in range(rounds + 1):
        after = stage.write(_step(state, np.stack(history), t == 0), f"round{t}")
        stage.drop(state)
        state = after
        if t < rounds:
            more, n = _sums(state, *centroids.shape)
            sums, sizes = sums + more, sizes + n
            some = sizes > 0
            centroids = centroids.copy()
            centroids[some] = sums[some] // sizes[some, None]
            history.append(centroids)
    last = history[-1].tolist()
    own = F.element_at(F.array(*[F.array(*[F.lit(v).cast("long") for v in c]) for c in last]), F.col("cluster") + 1)
    distance = F.aggregate(F.zip_with("v", own, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, v: s + v)
    return state.select("vec_id", "v", "cluster", distance.alias("distance"), "evaluated"), history[-1]


def clustered(rows: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each row; no rows give none."""
    spark, (found, centroids) = rows.sparkSession, kmeans(rows, k, rounds, seed)
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    prints = spark.createDataFrame([(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())], "cluster int, centroid_sha256 string")
    every = F.broadcast(sums.agg(F.sum("cluster_inertia").alias("inertia")))  # one row
    # A row for each cluster.
    small = sums.join(F.broadcast(prints), "cluster").join(every)
    return found.join(F.broadcast(small), "cluster").select("vec_id", F.col("cluster").cast("int"), "distance", "cluster_inertia", "inertia", "centroid_sha256")
