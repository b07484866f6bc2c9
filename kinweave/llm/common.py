"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(df: DataFrame) -> int:
    """Partitions to deal rows to: what the session shuffles to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def split_words(text: Column) -> Column:
    """Words of a text as an array, empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def remainder(doc_id: Column, n: int = 3) -> Column:
    """CRC-32 of an id's decimal text, modulo ``n``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that ``df`` has a column of."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` but for those that a result replaces."""
    return [c for c in df.columns if c.lower() not in names]


def bounded_sample(df: DataFrame, key: Column, most: int) -> DataFrame:
    """All rows if there are up to ``most``, else about that many, chosen by a hash of the key."""
    n = df.count()
    return df if n <= most else df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(most * (1 << 30) / n))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.transform(F.array(value), body)[0]


def possibly_in(df: DataFrame, column: str, ids: DataFrame, bits: int = 22) -> DataFrame:
    """Rows whose hash ``column`` may be among the ids of the one-column table ``ids``.

    A bitmap of fixed size is joined in memory (at most ``2**(bits - 6)`` rows), so it only
    saves work: rows that aren't among the ids may stay.
    """
    at = lambda c: F.pmod(F.shiftright(c, 7), F.lit(1 << bits))
    words = ids.select(at(F.col(ids.columns[0])).alias("_p")).groupBy((F.col("_p") / 64).cast("int").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_p % 64 as int))")).alias("_bits"))
    placed = df.withColumn("_p", at(F.col(column))).withColumn("_word", (F.col("_p") / 64).cast("int"))
    return placed.join(F.broadcast(words), "_word").filter("shiftrightunsigned(_bits, cast(_p % 64 as int)) & 1 = 1").drop("_p", "_word", "_bits")
