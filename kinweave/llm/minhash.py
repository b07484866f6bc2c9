"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds the distinct word shingles of its whole text. Documents with the
same set form one class and its smallest id stands for it. The ``K`` smallest hash values
of a set are its sketch; in two sets with Jaccard similarity 0.8 the number of common
sketch values is at least binomial(K, 0.8), and ``LEAST`` or more are common but for a
chance of about 2e-7. So both sketches, ordered by the number of sketches that hold a value,
share one of their ``K - LEAST + 1`` rarest values, and only these go to inverted lists. Pairs from the lists are kept if
the sketch of their union shows enough common values, and confirmed on full sets.

A list of up to ``SMALL`` documents gives all its pairs. For the shortest and the longest of
its longer ones, each document is paired with a few leaders, some at random and some that are typical: their
values are in the most other sketches, so they are similar to most. Confirmed
pairs merge components, and what then lies outside the largest component of its list is compared
with documents of such lists that share one of the rarest shingles of the full sets: one by one
with those of small components, and with those of a large one by differences from its anchor, a
typical member. Two sets whose differences are few enough in sum are similar, so the member
with the fewest settles those at once. Any others must have differences in common, which are
rare where shingles of the group are not, and meet by the rarest of these. So no link between
components is left out, and a document at the edge of a group of copies doesn't meet all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.operators.components import connected_components

K = 40
LEAST = 18
SMALL = 32
#: Leaders of a long list that are chosen at random, and because they are typical.
LEADERS, TYPICAL = 2, 6
#: Common differences from an anchor that a pair must show among its rarest, where it needs so many.
SHOWN = 3
#: Bits of the filter that keeps unrelated texts out of the verification; it only saves work.
FILTER_BITS = 22


class _Words(dict):
    """Word -> 64-bit hash; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_words = _Words()


def shingle_set(text: str | None, size: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
    if not len(words):
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = (out ^ h[i : len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketches(docs: DataFrame, size: int = 2, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, fp1, fp2, sketch``: set size, 128-bit print of the set, its k smallest values."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            n, fps, low = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                fps.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64))
                low.append(s[:k].tobytes())
            fp = np.array(fps).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(low, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, sketch binary")


def _values(rows: DataFrame, values: Callable[[list], list[np.ndarray]], column: str) -> DataFrame:
    """``value, doc_id, n``: one row for each value of each row of ``doc_id, n`` and a packed set."""
    schema = pa.schema([("value", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                own = values(part.column(2).to_pylist())
                doc, n = (np.repeat(part.column(i).to_numpy(), [len(x) for x in own]) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *own]).view(np.int64)), pa.array(doc), pa.array(n)], schema=schema)

    return rows.select("doc_id", "n", column).mapInArrow(run, "value long, doc_id long, n long")


def _rarest(values: DataFrame, common: Column) -> DataFrame:
    """``value, doc_id, n, held, at, typical``: of each set's values the rarest, all but ``common - 1`` of them.

    ``held`` is in how many sets a value is, ``at`` its place in the set's order by rarity, and
    ``typical`` grows with how often a set's values are held.
    Values of one set alone come first in that order but give no pair, so only their number counts:
    a set keeps the first of its other values, less ``common - 1``.
    """
    held = values.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    per = Window.partitionBy("doc_id")
    order = values.join(held, "value").withColumn("own", F.row_number().over(per.orderBy("held", "value"))).withColumns({"others": F.count("*").over(per), "total": F.sum("held").over(per)})
    at, typical = F.col("n") - F.col("others") + F.col("own") - 1, F.col("total") / F.least("n", F.lit(K))
    return order.filter(F.col("own") <= F.col("others") - common + 1).select("value", "doc_id", "n", "held", at.alias("at"), typical.alias("typical"))


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``a, b, common, sure`` for pairs whose union sketch doesn't rule them out.

    ``sure`` marks pairs whose sketches are their full sets: they are confirmed already.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("common", pa.int32()), ("sure", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, common, sure = [], [], []
            for i, (x, y, nx, ny) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                full = nx <= len(x) and ny <= len(y)
                both = np.intersect1d(x, y, assume_unique=True)
                if full:
                    fits = 100 * len(both) >= percent * (nx + ny - len(both))
                else:
                    last = np.union1d(x, y)[K - 1]
                    both = both[both <= last]
                    fits = len(both) >= LEAST
                if fits:
                    keep.append(i)
                    common.append(len(both))
                    sure.append(full)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())), pa.array(common, pa.int32()), pa.array(sure, pa.bool_())], schema=schema)

    side = lambda k: reps.select(F.col("doc_id").alias(k), F.col("sketch").alias(f"s{k}"), F.col("n").alias(f"n{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb", "na", "nb")
    return both.mapInArrow(run, "a long, b long, common int, sure boolean")


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents that may be among the ids, by a bitmap of fixed size that is joined in memory."""
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))
    bits = ids.select(at("doc_id").alias("h")).groupBy((F.col("h") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("bits"))
    marked = docs.withColumn("h", at("doc_id")).withColumn("word", (F.col("h") / 64).cast("int"))
    return marked.join(F.broadcast(bits), "word").filter("shiftrightunsigned(bits, cast(h % 64 as int)) & 1 = 1").drop("h", "word", "bits")  # at most 2**(FILTER_BITS - 6) rows


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int, stage: Staging) -> DataFrame:
    """``a, b`` of the pairs whose full sets are similar."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            keep = []
            for i, (a, b, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                if len(known) > 64:
                    known.clear()
                for key, text in ((a, x), (b, y)):
                    if key not in known:
                        known[key] = shingle_set(text, size)
                if similar(known[a], known[b], percent):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], schema=schema)

    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = stage.write(_among(docs, ids), "texts")
    both = pairs.select("a", "b").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
    out = stage.write(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct(), "links")
    stage.drop(texts)
    return out


def _outside(lists: DataFrame, links: list[DataFrame], stage: Staging) -> tuple[DataFrame, DataFrame]:
    """List entries with their component ``c``, and the largest component of each list that has several."""
    comps = connected_components(reduce(DataFrame.unionByName, links), "a", "b")
    placed = stage.write(lists.join(comps.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select("value", "doc_id", "n", "typical", F.coalesce("component", "doc_id").alias("c")), "placed")
    sizes = placed.groupBy("value", "c").agg(F.count("*").alias("k"))
    major = stage.write(sizes.groupBy("value").agg(F.max_by("c", "k").alias("major"), F.count("*").alias("parts")).filter("parts > 1").select("value", "major"), "major")
    return placed, major


def _packed_sets(texts: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, key, s``: the packed full set of each text with ``n`` shingles, and a 64-bit print of it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("s", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingle_set(t, size) for t in part.column(2).to_pylist()]
                keep = [i for i, (s, n) in enumerate(zip(sets, part.column(1).to_pylist(), strict=True)) if len(s) == n]
                rows = pa.array(keep, pa.int64())
                keys = np.array([xxhash.xxh3_64_intdigest(sets[i].tobytes()) for i in keep], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array(keys), pa.array([sets[i].tobytes() for i in keep], pa.binary())], schema=schema)

    return texts.select("doc_id", "n", "text").mapInArrow(run, "doc_id long, n long, key long, s binary")


def _differences(rows: DataFrame) -> DataFrame:
    """``c, key, doc_id, n, role, size, values``: what one of a set ``s`` and its anchor ``t`` has and the other lacks."""
    schema = pa.schema([("c", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("role", pa.int32()), ("size", pa.int64()), ("values", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [np.setxor1d(np.frombuffer(s, np.int64), np.frombuffer(t, np.int64), assume_unique=True) for s, t in zip(part.column(5).to_pylist(), part.column(6).to_pylist(), strict=True)]
                sizes = np.array([len(d) for d in sets], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(5)), pa.array(sizes), lists], schema=schema)

    return rows.select("c", "key", "doc_id", "n", "role", "s", "t").mapInArrow(run, "c long, key long, doc_id long, n long, role int, size long, values array<long>")


def _beside_large(near: DataFrame, crowd: DataFrame, sets: DataFrame, rows: int, percent: int, stage: Staging) -> DataFrame:
    """``a, b`` that connect documents with the large components ``c`` they may be similar to.

    ``near`` has ``x, m, c, home``: a document, its set's size, a component, and if documents
    that share this home are to meet each other there as well. With ``d`` the number of values
    that only one of two sets has, the sets are similar if ``(100 + percent) * d`` is at most
    ``(100 - percent)`` times the sum of their sizes, and ``d`` is the sum of their differences
    from the anchor less twice the common ones. So what is similar to any set without common
    differences is similar to the set of least score, too.
    """
    guests = near.select(F.col("x").alias("doc_id"), F.col("m").alias("n"), "c", F.when(F.col("home"), 2).otherwise(3).alias("role"))
    members = crowd.filter("large").select("doc_id", "n", "c", F.lit(1).alias("role"), "typical").join(near.select("c").distinct(), "c")
    anchors = members.groupBy("c").agg(F.max_by(F.struct("doc_id", "n"), F.struct("typical", "doc_id")).alias("t")).select("c", "t.doc_id", "t.n")
    anchors = anchors.join(sets, ["doc_id", "n"]).groupBy("c").agg(F.min("s").alias("t"))
    meet = members.drop("typical").unionByName(guests).join(sets, ["doc_id", "n"]).join(anchors, "c")
    diffs = stage.write(_differences(meet), "differences", rows)
    score = F.col("size") * (100 + percent) - F.col("n") * (100 - percent)
    least = lambda role: F.min_by(F.struct("doc_id", score.alias("score")), F.when(role, F.struct(score, F.col("doc_id"))))
    best = diffs.groupBy("c").agg(F.array(least(F.col("role") == 1), least(F.col("role") < 3)).alias("best")).select("c", F.explode("best").alias("best"))
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    stars = diffs.filter("role > 1").join(best, "c").filter((F.col("doc_id") != F.col("best.doc_id")) & (score + F.col("best.score") <= 0)).select(pair("doc_id", "best.doc_id"))

    each = diffs.select("c", "key", "doc_id", "n", "role", "size", F.explode("values").alias("value"))
    held = each.groupBy("c", "value").agg(F.count("*").alias("held")).filter("held > 1")
    per = Window.partitionBy("c", "key")
    order = each.join(held, ["c", "value"]).withColumn("own", F.row_number().over(per.orderBy("held", "value"))).withColumn("others", F.count("*").over(per))
    # Places before ``last`` count; a pair that needs ``k`` common differences shows up to SHOWN of them among all but its last ``k``.
    lists = stage.write(order.select("c", "value", "key", "doc_id", "n", "role", score.alias("score"), (F.col("others") - F.col("own")).alias("after")), "difference-lists")
    x = lists.filter("role > 1").select("c", "value", F.col("key").alias("kx"), F.col("doc_id").alias("x"), F.col("n").alias("m"), F.col("score").alias("x_score"), F.col("after").alias("x_after"))
    total = F.col("score") + F.col("x_score")
    need = F.ceil(total / F.lit(2.0 * (100 + percent)) - 1e-9)
    shown = F.least(F.lit(SHOWN), need)
    fits = (F.least("n", "m") * 100) >= (F.greatest("n", "m") * percent)
    early = (F.col("after") >= need - shown) & (F.col("x_after") >= need - shown)
    met = x.join(lists.filter("role < 3"), ["c", "value"]).filter((F.col("doc_id") != F.col("x")) & (total > 0) & fits & early)
    met = met.groupBy("c", "kx", "x", "key", "doc_id").agg(F.count("*").alias("k"), F.min(shown).alias("shown")).filter("k >= shown").select(pair("x", "doc_id"))
    return stage.write(stars.unionByName(met).distinct(), "beside-large", rows)


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; a
    component is named by its smallest ``doc_id``, the one that is kept. Empty and null texts
    are linked with nothing. Rows with a null ``doc_id`` are linked with nothing, have a null
    component and are kept. Rows that repeat a ``doc_id`` are one document with the links of all
    their texts, and all of them are kept or none. Other columns are ignored.
    """
    stage = Staging(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    all_ = stage.write(sketches(docs, size), "sketches")
    alive = all_.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    set_ = ["fp1", "fp2", "n_shingles"]
    classes = alive.groupBy(*set_).agg(F.min("doc_id").alias("rep"))
    members = stage.write(alive.select("doc_id", *set_).join(classes, set_).filter("doc_id != rep").select("doc_id", "rep").distinct(), "members")
    reps = alive.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *set_]).dropDuplicates(["doc_id", *set_])
    reps = stage.write(reps.select("doc_id", F.col("n_shingles").alias("n"), "sketch"), "classes")

    # Sets that any partner's sketch holds in full need the exact number of common values.
    n = F.col("n")
    all_of = F.ceil(n * percent / F.lit(100.0))
    postings = _rarest(_values(reps, lambda raw: [np.frombuffer(x, np.uint64) for x in raw], "sketch"), F.when(100 * n <= percent * K, all_of).otherwise(LEAST))
    live = stage.write(postings, "lists")
    fits = lambda x, y: (F.least(x, y) * 100) >= (F.greatest(x, y) * percent)
    small = live.filter(F.col("held") <= SMALL).select("value", "doc_id", "n")
    other = small.select("value", F.col("doc_id").alias("b"), n.alias("m"))
    pairs = small.join(other, "value").filter((F.col("doc_id") < F.col("b")) & fits(n, F.col("m"))).select(F.col("doc_id").alias("a"), "b")
    long_ = live.filter(F.col("held") > SMALL).select("value", "doc_id", "n", "held", "typical")
    by_size = Window.partitionBy("doc_id").orderBy("held", "value")
    ends = long_.withColumn("end", F.lag("value").over(by_size).isNull() | F.lead("value").over(by_size).isNull()).filter("end")
    doc, typical, part = F.struct("doc_id", "n"), F.struct("typical", "doc_id"), F.pmod(F.xxhash64("doc_id"), F.lit(TYPICAL))
    chosen = [*[F.min_by(doc, F.xxhash64("doc_id", F.lit(i))) for i in range(LEADERS)], *[F.max_by(doc, F.when(part == i, typical)) for i in range(TYPICAL)]]
    leaders = long_.groupBy("value").agg(F.array_distinct(F.array_compact(F.array(*chosen))).alias("l"))
    leaders = leaders.select("value", F.explode("l").alias("l")).select("value", F.col("l.doc_id").alias("b"), F.col("l.n").alias("m"))
    led = ends.join(leaders, "value").filter((F.col("doc_id") != F.col("b")) & fits(n, F.col("m"))).select(F.least("doc_id", "b").alias("a"), F.greatest("doc_id", "b").alias("b"))
    first = stage.write(_estimated(pairs.unionByName(led).distinct(), reps, percent), "pairs")

    links = [first.filter("sure").select("a", "b"), _confirmed(first.filter("NOT sure").select("a", "b"), docs, size, percent, stage)]
    # Long lists: what isn't in the largest component of its list meets documents of its lists
    # with which it shares one of the rarest values of the full sets: as many as two similar sets
    # can't both lack.
    placed, major = _outside(long_.select("value", "doc_id", "n", "typical"), links, stage)
    crowd = placed.join(major, "value").select("doc_id", "n", "c", "typical", (F.col("c") != F.col("major")).alias("minor")).groupBy("doc_id", "n", "c").agg(F.max("minor").alias("minor"), F.max("typical").alias("typical"))
    crowd = stage.write(crowd, "crowd")
    large = crowd.groupBy("c").agg(F.count("*").alias("k")).filter(F.col("k") > SMALL).select("c", F.lit(True).alias("large"))
    n_crowd = crowd.count()
    crowd_ = stage.write(crowd.join(large, "c", "left").withColumn("large", F.coalesce("large", F.lit(False))), "crowd", n_crowd)
    stage.drop(live, placed, major, crowd)
    crowd = crowd_
    texts = _among(docs, crowd.select("doc_id")).join(crowd.select("doc_id", "n"), "doc_id")
    sets = stage.write(_packed_sets(texts, size), "crowd-sets")
    values = stage.write(_values(texts, lambda raw: [shingle_set(t, size) for t in raw], "text"), "crowd-values")
    bucket = F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    rare = stage.write(_rarest(values, all_of).join(crowd.drop("typical"), ["doc_id", "n"]).select("value", "doc_id", "n", "at", "c", "minor", "large", bucket.alias("bucket")), "crowd-lists")
    x = [F.col("doc_id").alias("x"), n.alias("m"), F.col("c").alias("d"), F.col("at").alias("x_at"), F.col("large").alias("x_large")]
    stage.drop(values)
    outside = rare.filter("minor").select("value", *x, F.explode(F.array(*[F.col("bucket") + i for i in (-1, 0, 1)])).alias("bucket"))
    # Two similar sets share so many values that none of them can lack more of its rarest ones.
    shared = F.ceil((n + F.col("m")) * percent / (100.0 + percent) - 1e-9)
    early = (F.col("at") <= n - shared) & (F.col("x_at") <= F.col("m") - shared)
    # Large components: all their entries in a list count as one, with the loosest bounds.
    bounds = rare.filter("large").groupBy("value", "bucket", "c").agg(F.min("n").alias("n"), F.min(F.col("at") * (100 + percent) - n * 100).alias("slack"))
    may = (F.col("c") != F.col("d")) & (F.col("slack") + F.col("m") * percent <= 0) & (F.col("x_at") * (100 + percent) <= F.col("m") * 100 - n * percent)
    near = outside.join(bounds, ["value", "bucket"]).filter(may).groupBy("x", "m", "c", "x_large").agg(F.count("*").alias("k"))
    first_ = F.row_number().over(Window.partitionBy("x", "m").orderBy(F.desc("k"), "c")) == 1
    near = stage.write(near.select("x", "m", "c", (first_ & ~F.col("x_large")).alias("home")), "near", n_crowd)
    beside = _beside_large(near, crowd, sets, n_crowd, percent, stage)
    # Small components: documents meet one by one, but for those that have met beside a large one.
    homes = near.filter("home").select(F.col("x").alias("doc_id"), F.col("m").alias("n"), F.col("c").alias("home"))
    y = rare.filter("NOT large").join(homes, ["doc_id", "n"], "left")
    outside = outside.join(homes.select(F.col("doc_id").alias("x"), F.col("n").alias("m"), F.col("home").alias("x_home")), ["x", "m"], "left")
    apart = ~(F.col("x_large") & F.col("minor")) & ~F.coalesce(F.col("home") == F.col("x_home"), F.lit(False))
    met = outside.join(y, ["value", "bucket"]).filter((F.col("c") != F.col("d")) & fits(n, F.col("m")) & early & apart)
    met = met.select(F.least("doc_id", "x").alias("a"), F.greatest("doc_id", "x").alias("b")).unionByName(beside).distinct()
    met = stage.write(met, "late", n_crowd)
    stage.drop(rare, crowd, sets)
    links.append(_confirmed(met, docs, size, percent, stage))  # the prefixes of full sets say more than sketches
    comps = connected_components(reduce(DataFrame.unionByName, [*links, members.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))]), "a", "b")

    named = all_.select("doc_id", "n_shingles").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
