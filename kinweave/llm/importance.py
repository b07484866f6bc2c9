"""Resampling documents toward a target distribution by hashed n-grams.

A document's words are laid out with one separator after each and scanned once for running
CRCs. The CRC of any n-gram follows from the two prefixes at its ends: the checksum is linear
over GF(2), so the state before the n-gram, shifted by the n-gram's length, cancels out of the
state after it. No n-gram is ever built as a string. Counts of the buckets of all documents
and of the target give each bucket a gain; a document's weight is its mean gain, and seeded
Gumbel noise turns the largest weights into a draw without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.ranking import dense_index
from kinweave.functions.staging import Staging
from kinweave.llm.common import free, others

#: Reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)
#: Bytes of text that a task scans at a time, but for single longer texts.
BYTES = 4 << 20
#: Lengths of n-grams in bytes with a table of their own; longer ones are shifted in steps.
SHORT = 64


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table of one byte; shifts by 0 to SHORT - 1 bytes and by SHORT times powers of two, each as four tables of a byte."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, POLYNOMIAL ^ (one >> 1), one >> 1).astype(np.uint32)
    place = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    short = [place]
    for _ in range(SHORT):
        short.append(one[short[-1] & 0xFF] ^ (short[-1] >> 8))
    double = [short[SHORT]]
    for _ in range(31):
        double.append(_apply(double[-1], double[-1]))
    return one, np.stack(short[:SHORT]), np.stack(double)


def _apply(table: np.ndarray, states: np.ndarray) -> np.ndarray:
    return table[0][states & 0xFF] ^ table[1][states >> 8 & 0xFF] ^ table[2][states >> 16 & 0xFF] ^ table[3][states >> 24]


def shifted(states: np.ndarray, by: np.ndarray) -> np.ndarray:
    """States of a CRC after as many zero bytes each."""
    _, short, double = _tables()
    low, high = by % SHORT, by // SHORT
    out = short[low, 0, states & 0xFF] ^ short[low, 1, states >> 8 & 0xFF] ^ short[low, 2, states >> 16 & 0xFF] ^ short[low, 3, states >> 24]
    for bit in range(int(high.max(initial=0)).bit_length()):
        some = np.flatnonzero(high >> bit & 1)
        out[some] = _apply(double[bit], out[some])
    return out


def running_crcs(data: np.ndarray) -> np.ndarray:
    """State of the CRC (from 0, without final complement) before each byte and after the last one.

    The bytes are dealt to rows that are scanned side by side, once for the state at their
    ends and, when these have been carried from row to row, once for all states.
    """
    one, short, double = _tables()
    width = 1 << max(6, len(data).bit_length() // 2)
    rows = -(-len(data) // width) or 1
    columns = np.zeros(rows * width, np.uint8)
    columns[: len(data)] = data
    columns = np.ascontiguousarray(columns.reshape(rows, width).T)
    ends = np.zeros(rows, np.uint32)
    for column in columns:
        ends = one[(ends ^ column) & 0xFF] ^ (ends >> 8)
    over = double[int(math.log2(width // SHORT))]
    state, carried = np.zeros(1, np.uint32), np.zeros(rows, np.uint32)
    for i in range(1, rows):
        state = _apply(over, state) ^ ends[i - 1]
        carried[i] = state[0]
    states = np.empty((width + 1, rows), np.uint32)
    states[0] = carried
    for i, column in enumerate(columns):
        states[i + 1] = one[(states[i] ^ column) & 0xFF] ^ (states[i] >> 8)
    return np.append(states[:-1].T.ravel(), states[-1, -1])[: len(data) + 1]


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words (digits, letters, all beyond ASCII), and bytes with A to Z in lower case."""
    byte = np.arange(256)
    upper = (byte >= 65) & (byte <= 90)
    return (byte >= 128) | upper | (byte >= 97) & (byte <= 122) | (byte >= 48) & (byte <= 57), np.where(upper, byte + 32, byte).astype(np.uint8)


IN_WORD, LOWERED = _letters()


def features(texts: pa.Array, most: int = 2, buckets: int = 10_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each text, and text and bucket of each run of 1 to ``most`` consecutive words; null is an empty text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = IN_WORD[raw]
    edges = np.zeros(len(raw) + 1, bool)
    edges[offsets] = True
    first = inside & (edges[:-1] | ~np.append(False, inside[:-1]))
    at = np.flatnonzero(first)
    owner = np.searchsorted(offsets, at, side="right") - 1
    n_words = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    # One separator stands after each word.
    order = np.cumsum(first[inside]) - 1
    ends = np.cumsum(np.bincount(order, minlength=len(at)) + 1).astype(np.int64) if len(at) else np.zeros(0, np.int64)
    line = np.full(int(ends[-1]) if len(at) else 0, 32, np.uint8)
    line[np.arange(len(order)) + order] = LOWERED[raw[inside]]
    states = running_crcs(line)
    begins, stops = np.append(0, ends[:-1])[: len(at)], ends - 1
    who, found = [], []
    for n in range(1, most + 1):
        a, b = begins[: len(at) - n + 1], stops[n - 1 :]
        same = owner[: len(at) - n + 1] == owner[n - 1 :]
        a, b = a[same], b[same]
        crc = states[b] ^ shifted(states[a] ^ ONES, b - a) ^ ONES
        who.append(owner[: len(at) - n + 1][same])
        found.append(crc % np.uint32(buckets))
    return n_words, np.concatenate(who), np.concatenate(found).astype(np.int64)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of a column of up to ``BYTES`` bytes of text, or one longer text."""
    sizes, first = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + BYTES, side="right")))
        yield first, last
        first = last


def bucket_counts(docs: DataFrame, most: int = 2, buckets: int = 10_000, text: str = "text") -> np.ndarray:
    """Features of all texts in each bucket; a task sends a row for each bucket at most, and the driver gets as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                total += np.bincount(features(batch.column(0)[a:b], most, buckets)[2], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    out = np.zeros(buckets, np.int64)
    for r in docs.select(F.col(text).cast("string")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the logarithm of a bucket's share in the target over that in the source, one added to each count."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n)))) for a, b in zip(source, target, strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, most: int = 2, text: str = "text") -> DataFrame:
    """Columns of ``docs`` but its text, with ``n_words``, ``n_features`` and ``weight``, the floored mean gain of its features (0 without any).

    Columns of these names are replaced. A null text has no words.
    """
    kept = [c for c in others(docs, "n_words", "n_features", "weight") if c.lower() != text.lower()]
    (own,) = free(docs, "_words_of")
    schema = docs.select(*kept).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rest = batch.column(batch.num_columns - 1), batch.columns[:-1]
            for a, b in slices(texts):
                n_words, who, bucket = features(texts[a:b], most, len(gain))
                n = np.bincount(who, minlength=b - a)
                # Sums of whole numbers of up to 2**53 are exact.
                total = np.bincount(who, gain[bucket].astype(float), minlength=b - a).astype(np.int64)
                yield pa.record_batch([*(c[a:b] for c in rest), *(pa.array(v, pa.int64()) for v in (n_words, n, np.where(n > 0, total // np.maximum(n, 1), 0)))], names=schema.names)

    return docs.select(*kept, F.col(text).cast("string").alias(own)).mapInArrow(run, schema)


def noise(key: Column, seed: int = 7) -> Column:
    """Floored thousandths of Gumbel noise from a hash of seed and key; null for a null key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, most: int = 2, buckets: int = 10_000, seed: int = 7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` without its text, with ``n_words, n_features, weight, score, rank``.

    Of the rows with ``least_words`` words or more, ``percent`` per cent (rounded down) with the
    highest scores are drawn and ranked from 1, ties to the smaller id; others have a null
    rank. Rows with a null id have a null score and come last. Repeated rows are drawn one by
    one; which of equal rows gets which of their ranks is open. Columns of these names are replaced;
    without rows, or without a target, nothing special happens: all counts of that side are 0.
    """
    stage = Staging(docs.sparkSession, "resample")
    gain = gains(bucket_counts(docs, most, buckets, text), bucket_counts(target, most, buckets, text))
    scored = weighed(docs, gain, most, text).drop("score", "rank")
    scored = stage.write(scored.withColumn("score", F.col("weight") + noise(F.col(doc_id), seed)), "scored")
    fine = F.col("n_words") >= least_words
    drawn = scored.filter(fine).count() * percent // 100
    (tie,) = free(scored, "_tie")
    ranked = dense_index(scored.filter(fine).withColumn(tie, F.monotonically_increasing_id()), F.desc_nulls_last("score"), F.col(doc_id).asc_nulls_last(), tie, name="rank", start=1).drop(tie)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return ranked.unionByName(scored.filter(~fine).withColumn("rank", F.lit(None).cast("long")))
