"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target / size of the
source. Its whole part is certain; the fractional parts are rounded dependently: two open
fractions trade words, one's gain being the other's loss, until one of them is 0 or 1, with
chances that leave every expectation as it was. Chunks of documents of like size leave one
open document each, the chunks' residuals form the chunks of the next level, and so on
down to one open document for each size class; these trade from the largest to the smallest,
and the last one, often a large one, is rounded to the nearer end. The words that this leaves
over go to smaller documents, so what a source gives differs from its target by about a small
document.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.ranking import dense_index
from kinweave.functions.staging import Staging
from kinweave.llm.common import free, let, n_words

#: Documents of a chunk; a source's chunks shrink by this at each level.
CHUNK = 64
#: Size classes for each doubling of the size.
CLASSES = 4
#: Sources, or their size classes, whose table may be joined in memory.
SMALL_TABLE = 100_000
MOST = 3
#: Documents of each doubling of the size that may settle what is left over.
CHOICES = 4
#: Pairs of documents of a source that may trade places to settle the rest.
SWAPS = 3
#: Times that all sources are looked at again.
PASSES = 2


def source_targets(sizes: DataFrame, stage: Staging, most: int = MOST) -> DataFrame:
    """``source, source_size, n, target`` from ``source, size`` rows.

    Sources in order of code points, null last, weigh 1, 2, 3, 1, 2, 3, ... and share the total
    of all sizes; none gets over ``most`` times its size, and what it would get beyond goes
    to the others by weight, again and again until none is above. Each round is one sum
    over the table of sources, which is numbered by ranges, so there may be many of them.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = dense_index(per, F.col("source").asc_nulls_last(), name="rank").withColumn("weight", F.col("rank") % 3 + 1).withColumn("cap", F.col("source_size") * most)
    per = stage.write(per.drop("rank"), "sources")
    total = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n
    capped, rate, kept = -1, 0.0, F.lit(True)
    while True:
        open_ = F.when(kept, F.col("weight"))
        r = per.agg(F.coalesce(F.sum(F.when(~kept, F.col("cap"))), F.lit(0)).alias("cap"), F.count_if(~kept).alias("n"), F.sum(open_).alias("weight")).first()
        if r.n == capped or not r.weight:
            break
        capped, rate = r.n, (total - r.cap) / r.weight
        kept = F.col("cap") > F.lit(rate) * F.col("weight")
    target = F.least(F.col("cap").cast("double"), F.lit(float(rate)) * F.col("weight")) if capped >= 0 else F.col("cap").cast("double")
    return per.select("source", "source_size", "n", target.alias("target"))


def _uniform(*columns: Column) -> Column:
    """A reproducible number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(1 << 53)


def _round_chunk(members: Column, seed: int, level: int) -> Column:
    """Rounds the documents of one chunk; the last element of the result is the one still open.

    A document is ``(size, id, x)``; the state holds settled documents and the open one.
    """

    def trade(state: Column, new: Column) -> Column:
        a, b = state["open"], new
        wa, wb = a["size"].cast("double"), b["size"].cast("double")
        # Words that can move from b to a, and from a to b.
        to_a = F.least((1 - a["x"]) * wa, b["x"] * wb)
        to_b = F.least(a["x"] * wa, (1 - b["x"]) * wb)
        gain = _uniform(a["id"], b["id"], F.lit(seed), F.lit(level)) * (to_a + to_b) < to_b
        a_full, b_empty = to_a == (1 - a["x"]) * wa, to_a == b["x"] * wb
        a_empty, b_full = to_b == a["x"] * wa, to_b == (1 - b["x"]) * wb
        xa = F.when(gain, F.when(a_full, 1.0).otherwise(a["x"] + to_a / wa)).otherwise(F.when(a_empty, 0.0).otherwise(a["x"] - to_b / wa))
        xb = F.when(gain, F.when(b_empty, 0.0).otherwise(b["x"] - to_a / wb)).otherwise(F.when(b_full, 1.0).otherwise(b["x"] + to_b / wb))
        a_done = F.when(gain, a_full).otherwise(a_empty)
        doc = lambda d, x: F.struct(d["size"].alias("size"), d["id"].alias("id"), x.alias("x"))
        return F.struct(
            F.concat(state["done"], F.array(F.when(a_done, doc(a, xa)).otherwise(doc(b, xb)))).alias("done"),
            F.when(a_done, doc(b, xb)).otherwise(doc(a, xa)).alias("open"),
        )

    kind = "array<struct<size:bigint,id:string,x:double>>"
    ordered = F.reverse(F.array_sort(members))
    start = lambda m: F.struct(F.array().cast(kind).alias("done"), m[0].alias("open"))
    return F.transform(F.array(ordered), lambda m: F.aggregate(F.slice(m, F.lit(2), F.greatest(F.size(m) - 1, F.lit(0))), start(m), trade))[0]


def mix(docs: DataFrame, seed: int = 0, most: int = MOST, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, k, source, size, source_size, target, copies`` for every row.

    ``k`` tells rows apart that share ``doc_id``: a hash of text and source, so that a caller
    can join copies to texts; rows equal in all of these are numbered by ``nth`` (from 1).
    ``size`` is the number of words, 0 for a null text; documents without words give none and
    get the whole part of their copies. The same rows and seed give the same mix, however
    they are partitioned. An empty table gives an empty mix.
    """
    stage = Staging(docs.sparkSession, "mixing")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text), F.col(source)).alias("k"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    # Repeated rows shrink to one with their number before they are shuffled.
    same = rows.groupBy("doc_id", "k", "source", "size").agg(F.count("*").alias("rows"))
    rows = stage.write(same.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows"), "sizes")
    targets = stage.write(source_targets(rows.select("source", "size"), stage, most), "targets")
    per = targets.withColumnRenamed("source", "own").drop("n")
    if targets.count() <= SMALL_TABLE:  # else the join shuffles, with skewed sources split
        per = F.broadcast(per)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.join(per, F.col("source").eqNullSafe(F.col("own"))).drop("own").withColumn("rate", F.least(rate, F.lit(float(most))))
    whole = F.floor("rate")
    rows = rows.withColumn("base", whole.cast("long")).withColumn("x", F.col("rate") - whole)
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "k", "nth")
    kind = F.floor(F.log2(F.col("size").cast("double")) * CLASSES).cast("int")
    open_ = rows.filter("x > 0 AND size > 0").select(F.xxhash64("source", F.col("source").isNull()).alias("s"), kind.alias("kind"), F.struct("size", key.alias("id"), "x").alias("d"))
    counts = stage.write(open_.groupBy(F.col("s").alias("cs"), F.col("kind").alias("ckind")).agg(F.count("*").alias("n")), "classes")
    size = counts.agg(F.count("*").alias("rows"), F.max("n").alias("most")).first()
    open_ = open_.join(F.broadcast(counts) if size.rows <= SMALL_TABLE else counts, (F.col("s") == F.col("cs")) & (F.col("kind") == F.col("ckind"))).drop("cs", "ckind")
    settled, level, last = [], 0, not size.rows
    while not last:
        last = level > 0 and CHUNK**level >= size.most  # one open document of each class is left: all classes of a source
        chunks = F.ceil(F.col("n") / F.lit(float(CHUNK ** (level + 1)))).cast("long")
        deal = [F.lit(0).alias("kind"), F.lit(0).cast("long").alias("chunk")] if last else ["kind", F.pmod(F.xxhash64("d.id", F.lit(seed), F.lit(level)), chunks).alias("chunk")]
        out = open_.select("s", *deal, "n", "d").groupBy("s", "kind", "chunk").agg(F.max("n").alias("n"), F.collect_list("d").alias("m")).select("s", "kind", "n", _round_chunk(F.col("m"), seed, level).alias("r"))
        out = stage.write(out, f"level{level}")
        settled.append(out.select(F.explode("r.done").alias("d")).select("d.id", "d.x"))
        open_ = out.select("s", "kind", "n", F.col("r.open").alias("d"))
        level += 1
    if settled:
        settled.append(open_.select("d.id", F.round("d.x").alias("x")))
    rows = rows.withColumn("key", key)
    if settled:
        extra = reduce(DataFrame.unionByName, settled).select(F.col("id").alias("key"), F.col("x").cast("long").alias("extra"))
        rows = rows.join(extra, "key", "left")
    else:
        rows = rows.withColumn("extra", F.lit(None).cast("long"))
    taken = stage.write(rows.select("doc_id", "k", "nth", "source", "size", "source_size", "target", "key", (F.col("base") + F.coalesce("extra", F.lit(0))).alias("copies")), "taken")
    copies = F.col("copies") + F.coalesce("change", F.lit(0))
    for i in range(PASSES):
        moved = stage.write(_corrections(taken, seed + i, most), "corrections")
        if moved.count() <= SMALL_TABLE:
            moved = F.broadcast(moved)
        taken = taken.join(moved, "key", "left").withColumn("copies", copies).drop("change")
    return taken.select("doc_id", "k", "nth", "source", "size", "source_size", "target", "copies")


def _corrections(taken: DataFrame, seed: int, most: int) -> DataFrame:
    """``key, change`` of the documents whose copies change by one, so that each source meets its target.

    What rounding the last open document of a source leaves over goes to smaller ones, from large
    to small: a document is taken once more or once less if that lowers the error. Then, while
    more than the smallest document or a thousandth is left over, two documents may trade: one
    is taken once more, one once less, and the two are those that bring the source nearest to its
    target. ``CHOICES`` documents of each doubling of the size that can give and as many that
    can take are enough, so a source is one array of bounded size.
    """
    doc = F.struct("size", "key")
    draw = lambda can, i: F.min_by(doc, F.when(can, F.xxhash64("key", F.lit(seed), F.lit(i))))
    chosen = lambda can: F.array_distinct(F.array_compact(F.array(*[draw(can, i) for i in range(CHOICES)])))
    source = F.struct(F.xxhash64("source", F.col("source").isNull()).alias("h"), "source")
    kinds = taken.groupBy(source.alias("s"), F.floor(F.log2(F.greatest("size", F.lit(1)).cast("double"))).alias("kind")).agg(
        F.sum(F.col("copies") * F.col("size")).alias("words"), F.max("target").alias("target"),
        chosen((F.col("size") > 0) & (F.col("copies") < most)).alias("up"), chosen((F.col("size") > 0) & (F.col("copies") > 0)).alias("down"))
    marked = lambda c, change: F.transform(c, lambda d: F.struct(d["size"].alias("size"), d["key"].alias("key"), F.lit(change).alias("change")))
    per = kinds.groupBy("s").agg(F.max("target").alias("target"), (F.max("target") - F.sum("words")).alias("left"), F.flatten(F.collect_list(F.concat(marked("up", 1), marked("down", -1)))).alias("docs"))

    def step(state: Column, d: Column) -> Column:
        left = state["left"]
        better = (d["change"] * left > 0) & (2 * d["size"] <= 3 * F.abs(left)) & ~F.exists(state["moved"], lambda m: m["key"] == d["key"])
        return F.when(better, F.struct((left - d["change"] * d["size"]).alias("left"), F.concat(state["moved"], F.array(d)).alias("moved"))).otherwise(state)

    start = F.struct(F.col("left"), F.array().cast("array<struct<size:bigint,key:string,change:int>>").alias("moved"))

    def swap(state: Column, _: Column) -> Column:
        free_of = lambda change: F.filter("docs", lambda d: (d["change"] == change) & ~F.exists(state["moved"], lambda m: m["key"] == d["key"]))
        pair = lambda u, d: F.struct(F.abs(state["left"] - (u["size"] - d["size"])).alias("off"), u.alias("u"), d.alias("d"))
        pairs = lambda downs: F.flatten(F.transform(free_of(1), lambda u: F.transform(F.filter(downs, lambda d: d["key"] != u["key"]), lambda d: pair(u, d))))
        traded = lambda p: F.when(F.coalesce(p["off"] < F.abs(state["left"]), F.lit(False)), F.struct((state["left"] - (p["u"]["size"] - p["d"]["size"])).alias("left"), F.concat(state["moved"], F.array(p["u"], p["d"])).alias("moved"))).otherwise(state)
        enough = F.greatest(F.array_min(F.transform("docs", lambda d: d["size"])).cast("double"), F.col("target") / 1000)
        return F.when(F.abs(state["left"]) > enough, let(F.array_min(let(free_of(-1), pairs)), traded)).otherwise(state)

    one_by_one = lambda state: F.aggregate(F.reverse(F.array_sort("docs")), state, step)
    in_pairs = lambda state: F.aggregate(F.sequence(F.lit(1), F.lit(SWAPS)), state, swap)
    # In either order, as a document changes once at most; the better one counts.
    both = [in_pairs(one_by_one(start)), one_by_one(in_pairs(start))]
    ways = F.array(*[let(state, lambda s: F.struct(F.abs(s["left"]).alias("off"), F.lit(i).alias("i"), s["moved"].alias("moved"))) for i, state in enumerate(both)])
    moved = F.array_min(ways)["moved"]
    return per.select(F.explode(moved).alias("m")).select("m.key", F.col("m.change").alias("change"))


def repeat(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    k, nth, id_, copies, one = free(docs, "_k", "_nth", "_id", "_copies", "_one")
    keyed = docs.withColumn(k, F.xxhash64(F.col(text), F.col(source)))
    # Only repeated rows need numbers.
    repeats = mixed.filter("nth > 1").limit(1).count()
    keyed = keyed.withColumn(nth, F.row_number().over(Window.partitionBy(doc_id, k).orderBy(k)).cast("long") if repeats else F.lit(1).cast("long"))
    taken = mixed.filter("copies > 0").select(F.col("doc_id").alias(id_), F.col("k").alias(k), F.col("nth").alias(nth), F.col("copies").alias(copies))
    joined = keyed.join(taken, [k, nth]).filter(F.col(doc_id).eqNullSafe(F.col(id_)))
    return joined.withColumn(one, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(docs.columns)
