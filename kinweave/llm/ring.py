"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

A key's CRC is its place on a ring of fixed size, on which every shard has many virtual nodes;
the next node clockwise is the key's home. A shard takes home keys up to its bound; keys beyond
it continue clockwise to the first shard with room. Only keys that overflow move, so their
number is the least that the bounds allow, and the bounds guarantee the balance. Keys of one
arc share their way around the ring, so ways are found for whole arcs, whose number depends
on shards and nodes only; rows then look theirs up by their place among the arc's rows.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.ranking import dense_index
from kinweave.functions.staging import Staging
from kinweave.llm.common import free, others

#: Points of the ring: the leading bits of a CRC.
BITS = 16
#: Virtual nodes of a shard.
NODES = 64


def nodes(shards: int, each: int = NODES) -> list[tuple[int, int]]:
    """``point, shard`` of all virtual nodes in ring order. Shards may have nodes at the same point; the keys there belong to the smallest."""
    if not 0 < shards * each <= 1 << BITS:
        raise ValueError(f"{shards} shards of {each} nodes don't fit a ring of {1 << BITS} points")
    return sorted((crc32(f"{s}:{i}".encode()) >> (32 - BITS), s) for s in range(shards) for i in range(each))


def arcs_of(ring: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``arc, first, last``: points up to each node after the one before it; the last arc lies beyond the last node. Arcs without points are left out."""
    ends = [-1, *(point for point, _ in ring), (1 << BITS) - 1]
    return [(i, a + 1, b) for i, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]


def ways(ring: list[tuple[int, int]], loads: list[int], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``arc, first, last, shard, slot``: where the rows of each arc go, by their place in it, and the shard's slot of the first.

    First every shard takes its home rows, arc by arc, up to its bound, then what is left
    continues clockwise, again arc by arc. The arc beyond the last node belongs to the first one.
    """
    room, left, taken = list(bounds), list(loads), [0] * len(loads)
    out, filled = [], [0] * len(bounds)

    def take(arc: int, shard: int) -> None:
        n = min(left[arc], room[shard])
        if n:
            out.append((arc, taken[arc], taken[arc] + n - 1, shard, filled[shard]))
            left[arc] -= n
            taken[arc] += n
            room[shard] -= n
            filled[shard] += n

    for arc in range(len(loads)):
        take(arc, ring[arc % len(ring)][1])
    for arc in range(len(loads)):
        at = arc
        while left[arc]:
            take(arc, ring[at % len(ring)][1])
            at += 1
    return out


def bounds_of(rows: int, shards: int) -> list[int]:
    """Bounds that add up to the rows and are at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shard(docs: DataFrame, shards: int = 40, key: Column | str = "text", doc_id: str = "doc_id", each: int = NODES, hashed: bool = False) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, its place there; numbers of rows are at most one apart.

    Rows of equal keys (null counts as empty) share a place on the ring and so a shard, but where
    a shard fills up; a key that holds more rows than a shard may take fills several, one
    after the other. With ``hashed`` the key is a CRC-32 already (null counts as 0). Rows are
    in order of key and id in an arc; which of equal rows gets which of their places is open. Without rows there are none. Existing columns ``shard`` and ``slot`` are replaced.
    """
    spark, stage = docs.sparkSession, Staging(docs.sparkSession, "ring")
    key = F.col(key) if isinstance(key, str) else key
    names = others(docs, "shard", "slot")
    crc, point, arc, tie, place = free(docs.select(*names), "_crc", "_point", "_arc", "_tie", "_place")
    ring = nodes(shards, each)
    # A row for each point of the ring.
    arcs = spark.createDataFrame(arcs_of(ring), f"{arc} int, a int, b int").select(arc, F.explode(F.sequence("a", "b")).alias(point))
    value = F.coalesce(key, F.lit(0)) if hashed else F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    placed = docs.select(*names, value.alias(crc), F.monotonically_increasing_id().alias(tie))
    placed = placed.withColumn(point, F.shiftright(crc, 32 - BITS).cast("int")).join(F.broadcast(arcs), point).drop(point)
    # Arcs are runs of the order of keys, so a row's place in its arc is its number less that of the arc's first row.
    numbered = stage.write(dense_index(placed, crc, F.col(doc_id).asc_nulls_first(), tie, name=place), "numbered")
    loads = [0] * (len(ring) + 1)
    for r in numbered.groupBy(arc).agg(F.count("*").alias("n")).collect():  # arcs at most
        loads[r[arc]] = r.n
    first = [0]
    for n in loads:
        first.append(first[-1] + n)
    found = [(a, first[a] + x, first[a] + y, s, slot) for a, x, y, s, slot in ways(ring, loads, bounds_of(first[-1], shards))]
    # At most a row for each arc and each shard that fills up.
    table = spark.createDataFrame(found, f"{arc} int, _first long, _last long, shard int, _slot long")
    on = (numbered[arc] == table[arc]) & (numbered[place] >= F.col("_first")) & (numbered[place] <= F.col("_last"))
    joined = numbered.join(F.broadcast(table), on)
    return joined.select(*[numbered[c] for c in names], table["shard"], (F.col("_slot") + numbered[place] - F.col("_first")).alias("slot"))


def write_shards(sharded: DataFrame, path: str, shards: int, parts: int = 1) -> None:
    """Parquet folders ``shard=0``, ``shard=1``, ... whose files hold runs of ``slot`` in order; about ``parts`` tasks write a shard."""
    rows = sharded.repartitionByRange(shards * parts, "shard", "slot")
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
