"""Line dedup across documents by a segment-partition edit join.

Two lines within ``tau`` edits agree exactly on one of ``tau + 1`` segments of the shorter
one, at a place that their lengths bound. So each distinct line is indexed by its length
and segments and probes, for its own and each smaller length, the substrings that could
be such a segment. Pairs that meet are verified by banded bit-parallel edit distance on
what is left after their common prefix and suffix. Exact repeats go at any length.

For ``tau = 1`` a list of many distinct lines (templates, copies with changed words) is
split before any pair is made: agreeing but for one of ``PARTS`` parts, and where that still
is a long list, agreeing but for one character, where all members are linked.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm.common import free, let, others, tasks

#: Distinct lines of a list that give all their pairs.
SMALL = 64
PARTS = 32
#: A line is dealt to all tasks if its documents are over this share of a task's, and over so many.
HOT_SHARE, HOT_ROWS = 0.25, 100
#: Bits of the filter that keeps texts of unrelated lines out; it only saves work.
FILTER_BITS = 22
#: Binary steps of a common prefix: lines up to 2**24 characters that agree are compared whole.
STEPS = [1 << b for b in range(24, -1, -1)]


def _common_prefix(a: Column, b: Column) -> Column:
    """Number of first characters in which two strings agree."""

    def of(q: Column) -> Column:
        more = lambda n, step: F.when((n + step <= q["n"]) & (F.substr(q["a"], n + 1, step) == F.substr(q["b"], n + 1, step)), n + step).otherwise(n)
        return F.aggregate(F.array(*[F.lit(s) for s in STEPS]), F.lit(0), more)

    return let(F.struct(a.alias("a"), b.alias("b"), F.least(F.length(a), F.length(b)).alias("n")), of)


def _banded(x: Column, y: Column, tau: int) -> Column:
    """Edit distance of two strings, right up to ``tau`` and larger beyond.

    Bits stand for the 2 tau + 1 rows around the diagonal. For each character of ``y`` the
    band moves on by one row; the score follows the lowest row of the band until that row
    is the last one of ``x``, and then this row.
    """
    width = 2 * tau + 1
    mask, bit = (1 << width) - 1, lambda v, b: F.shiftright(v, b).bitwiseAND(1)
    n, m = F.length(x), F.length(y)
    row0 = F.least(F.lit(tau), n)

    def column(s: Column, j: Column) -> Column:
        c = F.substr(y, j, F.lit(1))
        match = F.lit(0)
        for b in range(width):
            row = j - tau + b
            match = match + F.when((row >= 1) & (row <= n) & (F.substr(x, F.greatest(row, F.lit(1)), F.lit(1)) == c), 1 << b).otherwise(0)

        def step(eq: Column) -> Column:
            d = (eq.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(eq).bitwiseOR(s["vn"]).bitwiseAND(mask)

            def after(d: Column) -> Column:
                hp = s["vn"].bitwiseOR(F.lit(mask) - d.bitwiseOR(s["vp"]))
                hn = d.bitwiseAND(s["vp"])
                low = F.shiftright(d, 1)
                vp = hn.bitwiseOR(F.lit(mask) - low.bitwiseOR(hp)).bitwiseAND(mask)
                vn = low.bitwiseAND(hp)
                inner = j + tau <= n
                at = F.greatest(n - j + tau, F.lit(0)).cast("int")
                across = F.when(at < width, F.expr("0") + F.pmod(F.floor(hp / F.pow(F.lit(2.0), at)), F.lit(2)) - F.pmod(F.floor(hn / F.pow(F.lit(2.0), at)), F.lit(2))).otherwise(0)
                score = s["score"] + F.when(inner, 1 - bit(d, width - 1)).otherwise(across)
                return F.struct(vp.cast("int").alias("vp"), vn.cast("int").alias("vn"), score.cast("int").alias("score"))

            return let(d, after)

        return let(match.cast("int"), step)

    start = F.struct(F.lit(mask - ((1 << tau) - 1)).cast("int").alias("vp"), F.lit(0).alias("vn"), row0.cast("int").alias("score"))
    columns = lambda last: F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    run = lambda last: F.aggregate(columns(last), start, column, lambda s: s["score"])
    # The score on the way never falls along a diagonal; far beyond the band it can't come back.
    early = F.least(m, n - tau, F.lit(4 * width))
    return F.when(F.abs(n - m) > tau, tau + 1).when((early > 0) & (run(early) > 3 * tau), tau + 1).otherwise(run(m))


def within(a: Column, b: Column, tau: int) -> Column:
    """Whether two strings are within ``tau`` edits."""

    def trimmed(pair: Column) -> Column:
        def tails(q: Column) -> Column:
            rest = lambda c: F.substr(q[c], q["p"] + 1, F.length(q[c]) - q["p"])
            return let(F.struct(rest("a").alias("x"), rest("b").alias("y")), middle)

        def middle(r: Column) -> Column:
            cut = lambda c, s: F.substr(r[c], F.lit(1), F.length(r[c]) - s)
            both = let(_common_prefix(F.reverse(r["x"]), F.reverse(r["y"])), lambda s: F.struct(cut("x", s).alias("x"), cut("y", s).alias("y")))
            return let(both, near)

        def near(z: Column) -> Column:
            return _banded(z["x"], z["y"], tau) <= tau

        return let(F.struct(pair["a"].alias("a"), pair["b"].alias("b"), _common_prefix(pair["a"], pair["b"]).alias("p")), tails)

    return F.when(F.abs(F.length(a) - F.length(b)) > tau, False).otherwise(let(F.struct(a.alias("a"), b.alias("b")), trimmed))


def segment_keys(line: Column, n: Column, tau: int) -> Column:
    """Hashed ``(length, segment, substring)`` keys of a line of ``n`` characters, with ``probe``.

    Keys of its own segments serve as index and as probe; the others only probe, at the
    places that a match with at most ``tau`` edits allows (multi-match-aware).
    """
    out = []
    for delta in range(tau + 1):
        m = n - delta
        for i in range(tau + 1):
            low = F.floor(m * i / (tau + 1)).cast("int")
            size = F.floor(m * (i + 1) / (tau + 1)).cast("int") - low
            for shift in range(max(-i, delta - (tau - i)), min(i, delta + (tau - i)) + 1):
                at = low + shift
                key = F.when((at >= 0) & (at + size <= n), F.xxhash64(m, F.lit(i), F.substr(line, at + 1, size)))
                out.append(F.struct(key.alias("key"), F.lit(not (delta == 0 and shift == 0)).alias("probe")))
    return F.filter(F.array(*out), lambda x: x["key"].isNotNull())


def _without_part(line: Column, n: Column) -> Column:
    """Keys of a line without each of ``PARTS`` parts, for its own length (index) and one less (probe)."""

    def keys(delta: int) -> Column:
        m = n - delta

        def key(j: Column) -> Column:
            bounds = F.struct(F.floor(m * j / PARTS).cast("int").alias("a"), F.floor(m * (j + 1) / PARTS).cast("int").alias("b"))
            rest = lambda s: F.xxhash64(m, j, F.substr(line, F.lit(1), s["a"]), F.substr(line, s["b"] + delta + 1, m - s["b"]))
            return let(bounds, lambda s: F.struct(rest(s).alias("key"), F.lit(delta == 1).alias("probe"), s["a"].alias("a"), s["b"].alias("b"), m.alias("m")))

        return F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), key)

    return F.concat(keys(0), keys(1))


def _without_character(line: Column, probe: Column, m: Column, a: Column, b: Column) -> Column:
    """Keys of a line that agrees with others but for part (a, b] of a length-m line.

    Lines that share a key ``(length, place, rest)`` are within one edit: either both lost
    the character at that place, or one is the other without it.
    """
    lost = lambda c, rest: F.xxhash64(rest, c, F.substr(line, F.lit(1), c - 1), F.substr(line, c + 1, F.length(line) - c))
    own = F.transform(F.sequence(a + 1, F.greatest(b, a + 1)), lambda c: lost(c, m - 1))
    whole = F.transform(F.sequence(a + 1, b + 1), lambda c: F.xxhash64(m, c, F.substr(line, F.lit(1), c - 1), F.substr(line, c, F.length(line) - c + 1)))
    longer = F.transform(F.sequence(a + 1, b + 1), lambda c: lost(c, m))
    return F.when(probe, longer).otherwise(F.concat(own, whole))


def _marked(df: DataFrame, h: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``h`` may be among the ids, by a bitmap of fixed size that is joined in memory."""
    at = lambda c: F.pmod(F.shiftright(c, 7), F.lit(1 << FILTER_BITS))
    bits = ids.select(at(F.col("h")).alias("p")).groupBy((F.col("p") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    marked = df.withColumn("p", at(F.col(h))).withColumn("word", (F.col("p") / 64).cast("int"))
    return marked.join(F.broadcast(bits), "word").filter("shiftrightunsigned(bits, cast(p % 64 as int)) & 1 = 1").drop("p", "word", "bits")  # at most 2**(FILTER_BITS - 6) rows


def _pairs(keys: DataFrame, lists: DataFrame) -> DataFrame:
    """``a, b`` of distinct lines that meet in a list of up to ``SMALL`` lines, one of them by its index."""
    some = keys.join(lists.filter((F.col("held") > 1) & (F.col("held") <= SMALL)).select("key"), "key")
    x, y = some.filter("NOT probe").select("key", F.col("h").alias("a")), some.select("key", F.col("h").alias("b"), "probe")
    met = x.join(y, "key").filter("a != b AND (probe OR a < b)")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def removed_lines(docs: DataFrame, tau: int = 1, min_chars: int = 32) -> DataFrame:
    """``doc_key, gone`` with the numbers (from 0) of the lines that each document loses; other documents have no row.

    ``docs`` has ``doc_key`` (a number for each distinct document), ``rank`` (which document
    counts as earlier) and ``text``. See :func:`dedup_lines` for which lines go.
    """
    stage = Staging(docs.sparkSession, "lines")
    all_ = docs.select("doc_key", "rank", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    every = all_.withColumn("n", F.length("line")).withColumn("h", F.xxhash64("line"))
    lines = every.filter(F.col("n") >= min_chars)
    placed = stage.write(every.groupBy("h", "doc_key", "rank").agg(F.min("pos").alias("first"), F.collect_list("pos").alias("places")), "places")
    firsts = stage.write(placed.groupBy("h").agg(F.min("rank").alias("rank"), F.count("*").alias("docs")), "firsts")

    keys = lines.select("h", F.explode(segment_keys(F.col("line"), F.col("n"), tau)).alias("k")).select("h", "k.key", "k.probe").groupBy("key", "h").agg(F.min("probe").alias("probe"))
    keys = stage.write(keys, "keys")
    lists = keys.groupBy("key").agg(F.count("*").alias("held"), F.count_if(~F.col("probe")).alias("own")).filter("held > 1 AND own > 0")
    live = stage.write(keys.join(lists, "key"), "live")
    stage.drop(keys)
    found = _marked(lines.select("h", "line", "n"), "h", live.select("h").distinct())
    texts = stage.write(found.groupBy("h").agg(F.first("line").alias("line"), F.first("n").alias("n")), "texts")

    candidates = [_pairs(live.select("key", "h", "probe"), live.select("key", "held").distinct())]
    beaten = []
    long_ = live.filter(F.col("held") > SMALL)
    if long_.limit(1).count():
        if tau != 1:  # no finer split: the list meets itself, by its key and in one order
            x, y = long_.filter("NOT probe").select("key", F.col("h").alias("a")), long_.select("key", F.col("h").alias("b"), "probe")
            candidates.append(x.join(y, "key").filter("a != b AND (probe OR a < b)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        else:
            crowd = texts.join(long_.select("h").distinct(), "h")
            finer = stage.write(crowd.select("h", F.explode(_without_part(F.col("line"), F.col("n"))).alias("k")).select("h", "k.*"), "finer")
            finer_lists = finer.groupBy("key").agg(F.count("*").alias("held"), F.count_if(~F.col("probe")).alias("own")).filter("held > 1 AND own > 0")
            candidates.append(_pairs(finer, finer_lists))
            dense = finer.join(finer_lists.filter(F.col("held") > SMALL).select("key"), "key").drop("key")
            rest = dense.join(texts, "h").select("h", F.explode(_without_character(F.col("line"), F.col("probe"), F.col("m"), F.col("a"), F.col("b"))).alias("key")).distinct()
            rest = stage.write(rest.join(firsts, "h").select("key", "h", "rank"), "characters")
            winner = rest.groupBy("key").agg(F.min("rank").alias("best"), F.count("*").alias("held")).filter("held > 1")
            beaten.append(rest.join(winner, "key").filter("rank > best").select("h"))

    pairs = reduce(DataFrame.unionByName, candidates).distinct()
    side = lambda c: texts.join(firsts, "h").select(F.col("h").alias(c), F.col("line").alias(f"{c}_line"), F.col("rank").alias(f"{c}_at"))
    linked = pairs.join(side("a"), "a").join(side("b"), "b").filter("a_at != b_at").filter(within(F.col("a_line"), F.col("b_line"), tau))
    beaten.append(linked.select(F.when(F.col("a_at") < F.col("b_at"), F.col("b")).otherwise(F.col("a")).alias("h")))
    lost = stage.write(reduce(DataFrame.unionByName, beaten).distinct().withColumn("lost", F.lit(True)), "lost")

    # Lines that hold over a share of a task's places, at most tasks over that share, are dealt to all tasks.
    parts = tasks(placed)
    total = firsts.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n")).first().n
    hot = F.broadcast(firsts.filter(F.col("docs") > max(HOT_ROWS, int(total / parts * HOT_SHARE))).select("h", F.lit(True).alias("hot")))
    known = firsts.filter("docs > 1").select("h", F.col("rank").alias("best")).join(lost, "h", "full_outer").join(hot, "h", "left")
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    known = known.select("h", "best", "lost", F.explode(copies).alias("part"))
    dealt = placed.join(hot, "h", "left").withColumn("part", F.when(F.col("hot"), F.pmod(F.col("doc_key"), F.lit(parts)).cast("int")).otherwise(0))
    judged = dealt.join(known, ["h", "part"], "left")
    gone = F.when(F.col("lost").isNotNull() | (F.col("rank") != F.coalesce("best", "rank")), F.col("places")).otherwise(F.filter("places", lambda p: p != F.col("first")))
    return judged.select("doc_key", gone.alias("gone")).filter(F.size("gone") > 0).groupBy("doc_key").agg(F.flatten(F.collect_list("gone")).alias("gone"))


def dedup_lines(docs: DataFrame, tau: int = 1, min_chars: int = 32, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, ``text`` without the lines that go, ``n_lines`` and ``n_kept`` (columns of these names are replaced).

    Lines are the parts between line feeds; those without a word always stay. Of equal lines,
    the first one of the document with the smallest id stays. A line of ``min_chars`` characters
    or more goes everywhere if it is within ``tau`` edits of a line that begins in an earlier document,
    be that one kept or not; near lines that begin in the same document both stay. Texts without
    lines left become empty. Null ids come last and count as one id; null texts stay null, with
    no lines. Rows equal in id and text are one document and lose the same lines. Lines and
    documents are told apart by 64-bit hashes.
    """
    key, lost = free(docs, "_key", "_gone")
    keyed = docs.withColumn(key, F.xxhash64(F.col(doc_id).cast("string"), F.col(text)))
    rank = F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))
    gone = removed_lines(keyed.filter(F.col(text).isNotNull()).select(F.col(key).alias("doc_key"), rank.alias("rank"), F.col(text).alias("text")), tau, min_chars)
    joined = keyed.join(gone.select(F.col("doc_key").alias(key), F.col("gone").alias(lost)), key, "left")
    lines = F.split(F.col(text), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(lost, F.array().cast("array<int>")))
    rest = let(lines, lambda x: F.array_join(F.transform(left, lambda i: F.get(x, i)), "\n"))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_kept = F.when(F.col(text).isNull(), 0).when(F.col(lost).isNull(), F.size(lines)).otherwise(F.size(left)).cast("long")
    kept = [F.when(F.col(lost).isNull(), F.col(c)).otherwise(rest).alias(c) if c == text else F.col(c) for c in others(docs, "n_lines", "n_kept")]
    return joined.select(*kept, n_lines.alias("n_lines"), n_kept.alias("n_kept"))
