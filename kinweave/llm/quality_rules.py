"""Quality rules: statistics of a text, and lines that too many documents of a host share.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm.common import SPACES, free, let, others, possibly_in, split_words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent lines that may be joined in memory, eight bytes each.
SMALL_TABLE = 200_000


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more.

    Windows are hashed and sorted with their places. Of equal neighbours both places count;
    the k-th repeated window in order of place adds its words beyond the one before.
    """
    windows = let(words, lambda w: F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))))

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.zip_with(hashes, F.sequence(F.lit(1), F.size(hashes)), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            before = F.concat(F.slice(p, 1, 1), F.slice(p, F.lit(1), F.size(p) - 1))
            after = F.concat(F.slice(p, F.lit(2), F.size(p) - 1), F.slice(p, F.size(p), F.lit(1)))
            near = F.zip_with(before, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
            marked = F.zip_with(p, near, lambda x, n: F.when(
                ((x["h"] == n["a"]["h"]) & (x["i"] != n["a"]["i"])) | ((x["h"] == n["b"]["h"]) & (x["i"] != n["b"]["i"])), x["i"]))
            return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n"))
        return F.aggregate(let(pairs, places), start, step, lambda acc: acc["n"])

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``; a null text counts as empty.

    Columns of these names are replaced, all others stay.
    """
    docs = docs.select(*[c for c in others(docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")])
    (counts,) = free(docs, "_counts")
    t = F.coalesce(F.col(text), F.lit(""))
    bare = _without(t, SPACES)
    lines = F.filter(F.split(t, "\n"), lambda x: _without(x, SPACES) != "")
    out = docs.withColumns({
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        counts: let(split_words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r"))),
    })
    out = out.withColumns({"n_words": F.col(counts)["n"], "n_repeat_words": F.col(counts)["r"]}).drop(counts)
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _normal(line: Column) -> Column:
    """Lower-cased, digits as 0, runs of white space as one space."""
    return F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]", "0"), r"[\x20\x09-\x0D]+", " ")


def depleted(docs: DataFrame, host: str, text: str, max_docs: int | None, min_left: float, share: float, least: int) -> DataFrame:
    """``_key`` of documents of which removed lines leave less than ``min_left`` of the characters of their distinct lines.

    A line of a host is one 64-bit hash from here on; only hashes and lengths are shuffled. Lines
    that few rows hold go first; of the others each document counts once, however often its row is
    repeated.
    """
    stage = Staging(docs.sparkSession, "lines")
    distinct = F.filter(F.array_distinct(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.trim(_normal(x)))), lambda x: x != "")
    hashed = let(distinct, lambda d: F.transform(d, lambda x: F.struct(F.xxhash64(x, F.col(host), F.col(host).isNull()).alias("h"), F.length(x).alias("n"))))
    of_host = F.xxhash64(F.col(host), F.col(host).isNull())
    rows = docs.select("_key", host, hashed.alias("x")).select("_key", F.aggregate("x", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("all"), of_host.alias("host"), F.explode("x").alias("x")).select("_key", "all", "host", "x.h", "x.n")
    lines = stage.write(rows, "lines")
    some = lines.groupBy("h").agg(F.count("*").alias("rows")).filter(F.col("rows") > (least if max_docs is None else max_docs)).select("h")
    shared = stage.write(possibly_in(lines, "h", stage.write(some, "some")).dropDuplicates(["_key", "h"]), "shared")
    held = shared.groupBy("h").agg(F.count("*").alias("held"), F.first("host").alias("host"))
    if max_docs is not None:
        often = held.filter(F.col("held") > max_docs)
    else:
        hosts = docs.select("_key", of_host.alias("host")).distinct().groupBy("host").agg(F.count("*").alias("docs"))
        often = held.filter(F.col("held") > least).join(hosts, "host").filter(F.col("held") > F.col("docs") * share)
    often = stage.write(often.select("h"), "often")
    if often.count() <= SMALL_TABLE:  # their lists are long by definition; beyond, the join shuffles and long lists are split
        often = F.broadcast(often)
    cut = shared.join(often, "h").groupBy("_key").agg(F.first("all").alias("all"), F.sum("n").alias("cut"))
    return cut.filter(F.col("all") - F.col("cut") < F.col("all") * min_left).select("_key")


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id", max_docs: int | None = None, min_left: float = 0.25, share: float = 0.02, least: int = 5) -> DataFrame:
    """All columns, the statistics of :func:`text_statistics`, and ``kept``.

    A document is dropped if it fails the base rules (fewer than 20 words, or over 30 % of
    them in repeated windows), or if removing lines that too many distinct documents of
    its host hold leaves less than ``min_left`` of the characters of its distinct normalised
    lines. Too many are over ``share`` of the host's documents and over ``least``, or over
    ``max_docs`` where that is given. Rows equal in id, text and host are one document, which counts
    once and is judged once; each of them gets its verdict. Null ids are fine; a null host is a
    host of its own; a null or empty text has no words and fails. Columns of ``docs`` that are named like
    a result are replaced.
    """
    docs = docs.select(*others(docs, "kept"))
    key, lost = free(docs, "_key", "_gone")
    of_row = F.xxhash64(F.col(doc_id).cast("string"), F.col(text), F.col(host), F.col(doc_id).isNull())
    gone = depleted(docs.select(of_row.alias("_key"), F.col(host).alias("_host"), F.col(text).alias("_text")), "_host", "_text", max_docs, min_left, share, least)
    gone = gone.select(F.col("_key").alias(key), F.lit(True).alias(lost))
    # Keys and numbers of the documents meet here, no texts unless the caller asks for them.
    joined = text_statistics(docs.withColumn(key, of_row), text).join(gone, key, "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col(lost).isNull()).drop(key, lost)
