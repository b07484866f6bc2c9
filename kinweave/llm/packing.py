"""Best-fit packing of token pieces, certified by dual-feasible lower bounds.

Pieces are dealt to groups of bounded size and each group is packed by best-fit decreasing.
Dual-feasible functions give a lower bound on any packing of a group's pieces; a group that
meets its bound is certified. Groups with a gap hand all pieces of sequences that are not
nearly full to the next round, as every group does with its least filled sequence; these
are dealt anew, among each other, and packed again until a round saves next to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm.common import free, others, tasks
from kinweave.llm.tokens import binaries, encode_column

CAPACITY = 4096
#: Pieces of a group; a task's memory follows from it.
GROUP_PIECES = 8192
#: A round must save this share of the sequences that it repacks, and one at least.
LEAST_WIN = 0.001


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; a piece goes where it leaves the least room, large ones first."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]  # room left -> open bins
    some, n_bins = 0, 0  # some: bit r is set if a bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = some >> size
        if fits and size:
            room = size + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
        elif size:
            b, room, n_bins = n_bins, capacity, n_bins + 1
        else:
            b, room = (max(n_bins - 1, 0), 0)  # an empty piece takes no room
            n_bins = max(n_bins, 1)
            bins[i], offsets[i] = b, 0
            continue
        bins[i], offsets[i] = b, capacity - room
        rooms[room - size].append(b)
        if room > size:
            some |= 1 << (room - size)
    return bins, offsets


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY, times: np.ndarray | None = None) -> int:
    """Largest of two families of dual-feasible functions, and of the plain volume; ``times`` counts repeated sizes.

    With threshold k, the first counts pieces above capacity - k as full and drops those
    below k; the second rounds x up to multiples of 1/k of the capacity (k + 1 pieces that
    fill it exactly stay themselves).
    """
    times = np.ones(len(sizes), np.int64) if times is None else times[sizes > 0]
    sizes, times = sizes[sizes > 0].astype(np.int64), times[: (sizes > 0).sum()]
    best = -(-int((sizes * times).sum()) // capacity)
    for k in np.unique(sizes[sizes <= capacity // 2])[:: max(1, len(sizes) // 256)]:
        total = capacity * int(times[sizes > capacity - k].sum()) + int((sizes * times)[(sizes >= k) & (sizes <= capacity - k)].sum())
        best = max(best, -(-total // capacity))
    for k in range(1, 33):
        scaled = sizes * (k + 1)
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * times).sum()) // (k * capacity)))
    return best


def pieces_of(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids``: ids of each text and its end id, long ones cut at the capacity.

    A null or empty text has its end id alone. ``ids`` are little-endian uint32.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, ids, counts in encode_column(path, batch.column(1), end_id):
                n = -(-counts // capacity)  # pieces of each document, one at least: its end id
                keys = batch.column(0).slice(first, last - first).take(pa.array(np.repeat(np.arange(last - first), n)))
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                length = np.minimum(np.repeat(counts, n) - piece * capacity, capacity)
                yield pa.RecordBatch.from_arrays([keys, pa.array(piece.astype(np.int32)), pa.array(piece * capacity), pa.array(length), binaries(ids.astype("<u4"), length).cast(pa.binary())], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def _pack_group(capacity: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("row_id", kind="stable")
        sizes = g["length"].to_numpy()
        bins, offsets = best_fit_decreasing(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        gap = len(fill) - lower_bound(sizes, capacity)
        again = fill < (capacity - capacity // 64 if gap > 0 else 0)
        again[np.argmin(fill)] |= fill.min() < capacity
        return pd.DataFrame({"row_id": g["row_id"], "length": sizes, "dealt": g["dealt"], "bin": bins, "offset": offsets, "again": again[bins], "gap": gap})

    return run


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces of 0 to ``capacity`` tokens (columns of these names are replaced).

    Placement works on row numbers and lengths alone and is joined back, so other columns
    (texts, ids, digests) pass through untouched. Groups are dealt by row number, so that no key,
    source or size can crowd one. Rounds end when one saves less than ``LEAST_WIN``; see
    :func:`certificate` for the gap that is left.
    """
    stage = Staging(pieces.sparkSession, "packing")
    kept, (row,) = others(pieces, "sequence_id", "offset"), free(pieces, "row_id")
    pieces = stage.write(pieces.select(*kept).withColumn(row, F.monotonically_increasing_id()), "pieces")
    todo = pieces.select(F.col(row).alias("row_id"), F.col(length).cast("long").alias("length"))
    n, base, placed, last, done, round_ = todo.count(), 0, [], None, False, 0
    while not done:
        groups = max(1, -(-n // GROUP_PIECES), min(4 * tasks(pieces), n // 1024))
        dealt = todo.withColumn("dealt", F.pmod(F.xxhash64("row_id", F.lit(round_)), F.lit(groups)).cast("int"))
        out = stage.write(dealt.groupBy("dealt").applyInPandas(_pack_group(capacity), "row_id long, length long, dealt int, bin long, offset long, again boolean, gap long"), f"round{round_}")
        ids = out.withColumn("sequence_id", (F.col("dealt").cast("long") + base) * F.lit(1 << 24) + F.col("bin"))
        base += groups
        sizes = out.filter("again").agg(F.count("*").alias("n"), F.countDistinct("dealt", "bin").alias("bins")).first()
        done = groups == 1 or sizes.bins <= 1 or (last is not None and last - sizes.bins < max(1, LEAST_WIN * last))
        placed.append((ids if done else ids.filter("NOT again")).select("row_id", "sequence_id", "offset"))
        todo, n, last, round_ = out.filter("again").select("row_id", "length"), sizes.n, sizes.bins, round_ + 1
    where = placed[0]
    for x in placed[1:]:
        where = where.unionByName(x)
    return pieces.join(where.withColumnRenamed("row_id", row), row).drop(row)


def certificate(packed: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """One row ``sequences, bound``: how many sequences there are and that any packing of the pieces needs.

    The bound comes from the number of pieces of each length, a table of ``capacity`` rows at most.
    """
    sizes = packed.groupBy(F.col(length).cast("long").alias("length")).agg(F.count("*").alias("n")).toPandas()
    bound = lower_bound(sizes["length"].to_numpy(np.int64), capacity, sizes["n"].to_numpy(np.int64))
    return packed.agg(F.countDistinct("sequence_id").alias("sequences"), F.lit(bound).cast("long").alias("bound"))
