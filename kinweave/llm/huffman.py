"""Token ids in Huffman-coded blocks.

The file format is a folder with two Parquet datasets. ``codes`` holds one row per used id
and the length of its code; the canonical code follows from the lengths. ``blocks`` holds,
in ascending document order, runs of whole documents: their ids and sizes, where each
document's bits begin, checkpoints (bit offsets of every 128th id of a document) and the
bits. Blocks need nothing but ``codes`` to be decoded, and checkpoints let one block be
decoded on many lanes at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm.common import tasks
from kinweave.llm.tokens import binaries, encode_column

#: Longest code in bits; 2**18 entries decode any code with one look-up.
MAX_BITS = 18
#: Ids between two checkpoints of a document.
STRIDE = 128
#: Ids after which a block ends; a block holds whole documents.
BLOCK_IDS = 1 << 19
#: Words that a task remembers, and bytes of text that it cuts at a time: more than by default,
#: as nothing else is in memory while texts are tokenized.
WORDS, BYTES = 1_000_000, 24 << 20


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for unused symbols."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    # Each level merges the leaves with the pairs of the level below; is_leaf marks the leaves.
    levels, packages = [], np.empty(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        levels.append(at < len(leaves))
        merged = both[at]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    lengths, take = np.zeros(len(order), np.int64), 2 * (len(order) - 1)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        lengths[:n] += 1
        take = 2 * (take - n)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for s in order[np.searchsorted(lengths[order], 1) :]:
        code <<= int(lengths[s]) - last
        last = int(lengths[s])
        codes[s] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length for each value of the next ``MAX_BITS`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[np.searchsorted(lengths[order], 1) :]
    spans = np.int64(1) << (MAX_BITS - lengths[order].astype(np.int64))
    symbols, sizes = np.repeat(order, spans), np.repeat(lengths[order], spans)
    rest = (1 << MAX_BITS) - len(symbols)
    return np.pad(symbols, (0, rest)).astype(np.uint16), np.pad(sizes, (0, rest), constant_values=1).astype(np.uint8)


def pack(docs: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Bits of all documents (each starts at a byte), byte offsets, and checkpoints of each document."""
    counts = np.array([len(d) for d in docs], np.int64)
    ids = np.concatenate(docs) if docs else np.empty(0, np.uint16)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    last = np.cumsum(counts)
    total = np.concatenate([[0], ends])
    bits = total[last] - total[last - counts]
    starts = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
    at = ends - size + np.repeat(starts[:-1] * 8 - total[last - counts], counts)
    out = np.zeros(int(starts[-1]) // 8 + 2, np.uint64)
    if len(ids):
        word, off = at >> 6, (at & 63).astype(np.uint64)
        top = codes[ids].astype(np.uint64) << (64 - size).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.add.reduceat(top >> off, first)
        over = np.flatnonzero(off.astype(np.int64) + size > 64)
        out[word[over] + 1] += top[over] << (np.uint64(64) - off[over])
    marks = [at[e - c : e : STRIDE] - s * 8 for e, c, s in zip(last, counts, starts[:-1], strict=True)]
    return out.astype(">u8").view(np.uint8)[: starts[-1]], starts, marks


def unpack(payload: bytes, lanes: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Ids of all lanes, one after the other; a lane is a bit offset and a number of ids."""
    symbols, lens = table
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.empty(int(sizes.sum()), np.uint16)
    to = np.cumsum(sizes) - sizes
    by_size = np.argsort(-sizes, kind="stable")  # lanes that go on are then a prefix
    pos, to, sizes = lanes[by_size].astype(np.int64), to[by_size], sizes[by_size]
    for step in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -step, side="left"))
        p = pos[:n]
        peek = (window[p >> 3] << (p & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        out[to[:n] + step] = symbols[peek]
        pos[:n] += lens[peek]
    return out


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def _emit(schema: pa.Schema, **columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def tokenize(docs: DataFrame, path: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: ids of each whole text as little-endian uint16; a null text has none."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, ids, counts in encode_column(path, batch.column(1), end_id, WORDS, BYTES):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(counts), binaries(ids, counts).cast(pa.binary())], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """``id, n`` over all documents; as many rows as the vocabulary has ids at most."""
    schema = pa.schema([("id", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield _emit(schema, id=used, n=total[used])

    return tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _encode_rows(lengths: np.ndarray) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("bits", pa.binary()), ("marks", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys, n, ids = _columns(batch.slice(at, 256), "doc_id", "n_tokens", "ids")
                out, starts, marks = pack([np.frombuffer(x, np.uint16) for x in ids], lengths, codes)
                yield _emit(schema, doc_id=keys, n_tokens=n, bits=[out[a:b].tobytes() for a, b in zip(starts, starts[1:], strict=False)], marks=[m.astype("<i8").tobytes() for m in marks])

    return run


_BLOCKS = "part int, block int, n_ids long, doc_ids array<long>, sizes array<long>, offsets array<long>, marks binary, payload binary"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole documents from rows in document order."""
    from pyspark import TaskContext

    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("marks", pa.binary()), ("payload", pa.binary())])
    part, block, rows, n_ids = TaskContext.get().partitionId(), 0, [], 0

    def close() -> pa.RecordBatch:
        keys, sizes, bits, marks = zip(*rows, strict=True)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in bits])])[:-1]
        return _emit(schema, part=[part], block=[block], n_ids=[n_ids], doc_ids=[keys], sizes=[sizes], offsets=[offsets], marks=[b"".join(marks)], payload=[b"".join(bits)])

    for batch in batches:
        for row in zip(*_columns(batch, "doc_id", "n_tokens", "bits", "marks"), strict=True):
            rows.append(row)
            n_ids += row[1]
            if n_ids >= BLOCK_IDS:
                yield close()
                block, rows, n_ids = block + 1, [], 0
    if rows:
        yield close()


def write_blocks(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = None) -> None:
    """Encode the ids of every text and write the file format to ``path``.

    Texts are tokenized where they are read. The code comes from the counts of all ids (the
    driver holds a count for each id of the vocabulary). Coded documents, smaller than
    texts and ids, are what the range shuffle on ``doc_id`` moves. A null ``doc_id`` comes
    first; rows with one ``doc_id`` are ordered by size and bits.
    """
    spark = docs.sparkSession
    stage = Staging(spark, "huffman")
    tokens = stage.write(tokenize(docs, tokenizer, end_id), "tokens")
    counts = np.zeros(1 << 16, np.int64)
    for row in id_counts(tokens).collect():  # bounded by the vocabulary
        counts[row.id] = row.n
    lengths = code_lengths(counts)
    coded = stage.write(tokens.mapInArrow(_encode_rows(lengths), "doc_id long, n_tokens long, bits binary, marks binary"), "coded")
    stage.drop(tokens)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int").coalesce(1).write.parquet(f"{path}/codes")
    ordered = coded.repartitionByRange(tasks(docs), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", F.xxhash64("bits"))
    ordered.mapInArrow(_assemble, _BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    stage.drop(coded)


def read_lengths(spark: SparkSession, path: str) -> np.ndarray:
    lengths = np.zeros(1 << 16, np.uint8)
    for row in spark.read.parquet(f"{path}/codes").collect():  # bounded by the vocabulary
        lengths[row.id] = row.bits
    return lengths


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``part, block, own, doc_id, n_tokens, ids`` of every document, decoded block by block.

    ``ids`` are little-endian unsigned 32-bit integers; ``own`` counts the ids before the
    document in its block.
    """
    lengths = read_lengths(spark, path)
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("own", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for batch in batches:
            for part, block, keys, sizes, offsets, marks, payload in zip(*_columns(batch, "part", "block", "doc_ids", "sizes", "offsets", "marks", "payload"), strict=True):
                size, n_lanes = np.array(sizes, np.int64), (np.array(sizes, np.int64) + STRIDE - 1) // STRIDE
                lanes = np.frombuffer(marks, "<i8") + np.repeat(np.array(offsets, np.int64) * 8, n_lanes)
                lane_ids = np.full(len(lanes), STRIDE, np.int64)
                full = n_lanes > 0
                lane_ids[np.cumsum(n_lanes)[full] - 1] = size[full] - (n_lanes[full] - 1) * STRIDE
                ids = unpack(payload, lanes, lane_ids, table).astype("<u4")
                ends = np.cumsum(size)
                yield _emit(schema, part=[part] * len(keys), block=[block] * len(keys), own=ends - size, doc_id=keys, n_tokens=sizes, ids=[ids[e - n : e].tobytes() for e, n in zip(ends, size, strict=True)])

    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "doc_ids", "sizes", "offsets", "marks", "payload")
    return blocks.mapInArrow(run, "part int, block int, own long, doc_id long, n_tokens long, ids binary")


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, block, first``: number of ids before each block; sums over parts, then within a part."""
    sizes = spark.read.parquet(f"{path}/blocks").select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("own", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part").select("part", "block", (F.col("base") + F.col("own")).alias("first"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    docs = read_blocks(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return docs.join(block_starts(spark, path), ["part", "block"]).select("doc_id", (F.col("first") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")
