"""Genes around each query in its genome, and families that occur with clusters.

The gene table has ``genome, accession, num, linear, normal, start, stop``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.ranking import dense_index
from kinweave.functions.staging import Staging
from kinweave.operators.stats import cut2

#: Largest window to either side.
MAX_SIZE = 20
NONE = "none"
#: Windows to one side that a bucket of a genome is long, two at least.
WIDE = 4
#: Queries of a cluster that are counted in one place.
LOT = 10_000


def choose_genome(queries: DataFrame, genes: DataFrame) -> DataFrame:
    """One gene row per query, with ``max_num`` and ``max_stop`` of its genome. ``queries``: ``accession``.

    On circular genomes: the one with most genes. Else a genome with over ten genes before
    the query comes first, then over ten after it, then the most central; ties by genome.
    """
    own = genes.join(queries.select("accession").distinct(), "accession", "left_semi")
    sizes = genes.join(own.select("genome").distinct(), "genome", "left_semi").groupBy("genome").agg(F.max("num").alias("max_num"), F.max_by("stop", "num").alias("max_stop"))
    rows = own.join(sizes, "genome")
    left, right = F.col("num") > 10, F.col("num") < F.col("max_num") - 10
    order = [F.col("linear").asc(), F.when(~F.col("linear"), -F.col("max_num")).asc(), F.when(F.col("linear"), left).desc(), F.when(F.col("linear"), right).desc(), F.when(F.col("linear"), F.abs(F.col("num") / F.col("max_num") - 0.5)).asc(), F.col("genome").asc(), F.col("num").asc()]
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("accession").orderBy(*order))).filter("_r = 1").drop("_r")


def in_clusters(chosen: DataFrame, clusters: DataFrame) -> DataFrame:
    """Chosen genes with the columns of their clusters (``cluster_num, query`` and more); a gene of several clusters has a row for each."""
    return chosen.join(clusters.withColumnRenamed("query", "accession"), "accession")


def _window(chosen: DataFrame, genes: DataFrame, size: int, carry: tuple[str, ...]) -> DataFrame:
    """:func:`neighbor_window` with ``_bucket``; its rows lie where (``genome``, ``_bucket``) puts them, so a query's are in one place unless it is near an end.

    Genomes are cut into buckets of ``WIDE`` windows. A gene is copied to the next bucket if queries
    there reach it, and a query asks its own bucket, and for what lies around the end the buckets
    there, whose own genes it takes from.
    """
    low, high = F.col("q_num") - size, F.col("q_num") + size
    wraps = ~F.col("q_linear") & (F.lit(size) < F.col("max_num"))
    wrap_from, wrap_to = F.when(wraps & (low < 1), F.col("max_num") + low), F.when(wraps & (high > F.col("max_num")), high - F.col("max_num"))
    q = chosen.select("genome", F.col("accession").alias("query"), F.col("num").alias("q_num"), F.col("linear").alias("q_linear"), F.col("normal").alias("q_normal"), F.col("start").alias("q_start"), F.col("stop").alias("q_stop"), "max_num", "max_stop", *carry)
    q = q.withColumns({"low": low, "high": high, "wrap_from": wrap_from, "wrap_to": wrap_to})
    bucket = lambda c: F.floor(c / (WIDE * max(size, 1))).cast("long")
    none = F.array().cast("array<bigint>")
    ends = F.array_distinct(F.concat(
        F.when(F.col("wrap_from").isNotNull(), F.sequence(bucket(F.col("wrap_from")), F.greatest(bucket(F.col("wrap_from")), bucket(F.col("max_num"))))).otherwise(none),
        F.when(F.col("wrap_to").isNotNull(), F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), bucket(F.col("wrap_to"))))).otherwise(none)))
    ask = lambda at, wrap: F.struct(at.alias("_bucket"), F.lit(wrap).alias("_wrap"))
    asked = q.select("*", F.explode(F.concat(F.array(ask(bucket(F.col("q_num")), False)), F.transform(ends, lambda x: ask(x, True)))).alias("_ask")).select(*q.columns, "_ask.*")
    at = bucket(F.col("num"))
    placed = genes.select("*", F.explode(F.array_distinct(F.array(at, bucket(F.col("num") - size), bucket(F.col("num") + size)))).alias("_bucket")).withColumn("_own", F.col("_bucket") == at)
    inside = (F.col("num") >= F.col("low")) & (F.col("num") <= F.col("high"))
    around = F.coalesce(F.col("num") >= F.col("wrap_from"), F.lit(False)) | F.coalesce(F.col("num") <= F.col("wrap_to"), F.lit(False))
    return asked.join(placed, ["genome", "_bucket"]).filter(F.when(F.col("_wrap"), F.col("_own") & ~inside & around).otherwise(inside)).drop("_wrap", "_own")


def neighbor_window(chosen: DataFrame, genes: DataFrame, size: int = MAX_SIZE, carry: tuple[str, ...] = ()) -> DataFrame:
    """Genes of the query's genome within ``size`` places, around the ends of circular genomes that are larger.

    Places are numbered from 1. Genomes are cut into buckets, so a long genome gives each query a bounded
    number of candidates. Further columns of ``genes`` and those of ``chosen`` in ``carry`` are
    passed on: what is known of a gene or a query is joined before the window multiplies them.
    """
    return _window(chosen, genes, size, carry).drop("_bucket")


def _distance():
    """Signed distance in a window, and whether its gene lies around the start or the end."""
    before = (F.col("num") > F.col("high")) & F.col("wrap_from").isNotNull()
    after = (F.col("num") < F.col("low")) & F.col("wrap_to").isNotNull()
    return F.col("num") - F.col("q_num") + F.when(before, -F.col("max_num")).when(after, F.col("max_num")).otherwise(0), before, after


def neighbor_distance(window: DataFrame, *carry: str) -> DataFrame:
    """Signed distance, relative places, residue length and direction of each neighbour, and the columns in ``carry``; the query itself goes."""
    distance, before, after = _distance()
    start = F.when(before, F.col("start") - F.col("max_stop")).when(after, F.col("max_stop") + F.col("start")).otherwise(F.col("start")) - F.col("q_start")
    length = F.abs(F.col("stop") - F.col("start"))
    words = lambda c: F.when(F.col(c), "normal").otherwise("complement")
    out = window.select(
        "query", "genome", F.col("accession").alias("neighbor"), "num", distance.cast("long").alias("distance"), start.cast("long").alias("rel_start"), (start + length).cast("long").alias("rel_stop"),
        F.greatest(F.expr("try_cast(abs(stop - start) / 3 - 1 AS bigint)"), F.lit(-1)).alias("seq_len"), words("normal").alias("direction"), words("q_normal").alias("query_direction"), F.when(F.col("linear"), "linear").otherwise("circular").alias("type"), *carry)
    return out.filter("distance != 0")


def gene_families(families: DataFrame, accession: str = "accession") -> DataFrame:
    """``accession, family``: distinct sorted family ids joined by ``-``. ``families``: ``accession, family``."""
    return families.groupBy(accession).agg(F.array_join(F.array_sort(F.collect_set("family")), "-").alias("family"))


def with_families(neighbors: DataFrame, families: DataFrame) -> DataFrame:
    """Adds the joined families of each neighbour, ``none`` where it has none."""
    known = gene_families(families).withColumnRenamed("accession", "neighbor")
    return neighbors.join(known, "neighbor", "left").withColumn("family", F.coalesce(F.when(F.col("family") != "", F.col("family")), F.lit(NONE)))


def genes_with_families(genes: DataFrame, families: DataFrame) -> DataFrame:
    """Adds the joined families of each gene, ``none`` where it has none. ``families``: ``accession, family``."""
    return genes.join(gene_families(families), "accession", "left").withColumn("family", F.coalesce(F.when(F.col("family") != "", F.col("family")), F.lit(NONE)))


def query_status(queries: DataFrame, chosen: DataFrame, neighbors: DataFrame, size: int = MAX_SIZE) -> DataFrame:
    """``query, status, edge``: nomatch, noneighbor or ok; edge of the contig 1 left, 2 right, 3 both."""
    at = chosen.select(F.col("accession").alias("query"), F.when(F.col("num") - size < 1, 1).otherwise(0).bitwiseOR(F.when(F.col("num") + size > F.col("max_num"), 2).otherwise(0)).alias("edge"))
    some = neighbors.select("query", F.lit(True).alias("_n")).distinct()
    status = F.when(F.col("edge").isNull(), "nomatch").when(F.col("_n").isNull(), "noneighbor").otherwise("ok")
    return queries.select(F.col("accession").alias("query")).distinct().join(at, "query", "left").join(some, "query", "left").select("query", status.alias("status"), "edge")


def _of_families(rows: DataFrame) -> DataFrame:
    """:func:`family_neighbors` of written rows ``cluster_num, family, query, away``.

    Queries are counted once for each family before they meet the family's row, and the median runs
    over counts of distances, of which a window has few; a family of all clusters stays spread.
    """
    keys = ["cluster_num", "family"]
    queries = rows.select(*keys, "query").distinct().groupBy(*keys).agg(F.count("*").alias("num_queries"))
    away = rows.groupBy(*keys, "away").agg(F.count("*").alias("n"))
    out = away.groupBy(*keys).agg(F.sum("n").alias("num_neighbors"), F.sum(F.col("n") * F.col("away")).alias("_s"), F.percentile("away", F.lit(0.5), F.col("n")).alias("_m"))
    out = out.join(queries, keys)
    return out.select(*keys, "num_queries", "num_neighbors", cut2(F.col("_s"), F.col("num_neighbors")).alias("average_distance"), (F.floor(F.col("_m") * 100) / 100).alias("median_distance"))


def family_neighbors(clusters: DataFrame, neighbors: DataFrame) -> DataFrame:
    """Per cluster and family: queries with it, neighbours, mean and median distance (cut to two decimals).

    ``clusters``: ``cluster_num, query``; ``neighbors``: with ``family`` (not null; ``none`` where there is none).
    Neighbours are evaluated once and written to the shared folder.
    """
    stage = Staging(neighbors.sparkSession, "families")
    near = neighbors.select("query", "family", F.abs("distance").alias("away"))
    return _of_families(stage.write(clusters.join(near, "query").select("cluster_num", "family", "query", "away"), "rows"))


def _counts_of_queries(chosen: DataFrame, genes: DataFrame, size: int) -> DataFrame:
    """``cluster_num, _lot, family, query, _p0.., _many``: how many neighbours of a family each query has at each distance.

    Counted where the window is made, so a row for each query and family is moved and not one for each
    neighbour. Counts are packed, ten of six bits in a number; those of a query with over 63
    neighbours of one family are listed in ``_many``. A query near an end may have several rows.
    """
    clusters = chosen.groupBy("cluster_num").agg(F.ceil(F.count("*") / LOT).alias("_lots")).withColumnRenamed("cluster_num", "_c")
    lots = chosen.join(clusters, F.col("cluster_num") == F.col("_c"), "left").withColumn("_lot", F.pmod(F.xxhash64("accession"), F.coalesce("_lots", F.lit(1))).cast("int"))
    away = F.abs(_distance()[0])
    near = _window(lots, genes, size, ("cluster_num", "_lot")).withColumn("away", away).filter("away != 0")
    at = range(1, size + 1)
    counted = near.groupBy("genome", "_bucket", "cluster_num", "_lot", "family", "query").agg(*[F.count_if(F.col("away") == i).alias(f"_{i}") for i in at], F.count_if(F.col("away") > size).alias("_far"))
    sum_ = lambda columns: reduce(lambda x, y: x + y, columns)
    few = sum_([F.col(f"_{i}") for i in at]) <= 63
    packed = [sum_([F.shiftleft(F.col(f"_{i}"), 6 * k) for k, i in enumerate(at[j : j + 10])]) for j in range(0, size, 10)]
    packed[0] = F.when(F.col("_far") > 0, F.raise_error(F.lit("places of a genome are numbered from 1")).cast("long")).otherwise(packed[0])
    many = F.when(~few, F.array(*[F.col(f"_{i}") for i in at]))
    return counted.select("cluster_num", "_lot", "family", "query", *[x.alias(f"_p{j}") for j, x in enumerate(packed)], many.alias("_many"))


def _families_of_counts(counts: DataFrame, size: int) -> DataFrame:
    """:func:`family_neighbors` of :func:`_counts_of_queries`. A cluster's queries are dealt to lots, so a large one is counted in several places."""
    keys, at = ["cluster_num", "family"], range(1, size + 1)
    field = lambda i: F.shiftrightunsigned(F.col(f"_p{(i - 1) // 10}"), 6 * ((i - 1) % 10)).bitwiseAND(F.lit(63).cast("long"))
    each = counts.repartition(*keys, "_lot").groupBy(*keys, "_lot", "query").agg(*[F.sum(F.when(F.col("_many").isNull(), field(i)).otherwise(F.get("_many", F.lit(i - 1)))).alias(f"_{i}") for i in at])
    out = each.groupBy(*keys).agg(F.count("*").alias("num_queries"), *[F.sum(f"_{i}").alias(f"_{i}") for i in at])
    upto = [F.col("_1")]
    for i in at[1:]:
        upto.append(upto[-1] + F.col(f"_{i}"))
    out = out.select(*keys, "num_queries", upto[-1].alias("num_neighbors"), reduce(lambda x, y: x + y, [F.col(f"_{i}") * i for i in at]).alias("_s"), F.array(*upto).alias("_upto"))
    # The distance at a rank from 0 is one more than the number of distances whose neighbours end before it.
    place = lambda rank: F.size(F.filter("_upto", lambda n: n <= rank)) + 1
    median = (place(F.floor((F.col("num_neighbors") - 1) / 2)) + place(F.floor(F.col("num_neighbors") / 2))) / 2
    return out.select(*keys, "num_queries", "num_neighbors", cut2(F.col("_s"), F.col("num_neighbors")).alias("average_distance"), (F.floor(median * 100) / 100).alias("median_distance"))


def genome_families(chosen: DataFrame, genes: DataFrame, size: int = MAX_SIZE) -> DataFrame:
    """:func:`family_neighbors` straight from genes: ``chosen`` with ``cluster_num``, ``genes`` with ``family``."""
    return _families_of_counts(_counts_of_queries(chosen, genes, size), size)


def genome_cooccurrence(clusters: DataFrame, chosen: DataFrame, genes: DataFrame, threshold: float = 0.0, strict: bool = False, size: int = MAX_SIZE) -> DataFrame:
    """:func:`cooccurrence` straight from genes: ``clusters`` as there, ``chosen`` genes without cluster, ``genes`` with ``family``.

    The counts of each query and family are written to the shared folder, neighbours are not.
    """
    stage = Staging(genes.sparkSession, "cooccurrence")
    counts = stage.write(_counts_of_queries(in_clusters(chosen, clusters.select("cluster_num", "query")), genes, size), "counts")
    some = counts.select("cluster_num", "query").distinct().groupBy("cluster_num").agg(F.count("*").alias("_n"))
    den = clusters.groupBy("cluster_num").agg(F.countDistinct("query").alias("num_seqs")).filter("num_seqs >= 2").join(some, "cluster_num")
    out = _families_of_counts(counts, size).join(den.withColumnRenamed("_n", "num_with_neighbors"), "cluster_num").withColumn("cooccurrence", cut2(F.col("num_queries"), F.col("num_with_neighbors")))
    return out.filter(F.col("cooccurrence") > threshold if strict else F.col("cooccurrence") >= threshold)


def _arrangement():
    return F.concat_ws(":", "query", "query_direction", "neighbor", "direction", "distance").alias("arrangement")


def genome_arrangements(chosen: DataFrame, genes: DataFrame, size: int = MAX_SIZE) -> DataFrame:
    """:func:`family_arrangements` straight from genes: ``chosen`` with ``cluster_num``, ``genes`` with ``family``.

    A query meets a gene at one distance only, so once genes and queries are distinct, so are the texts; only
    where an id holds a colon may two texts be equal by chance.
    """
    once = genes.dropDuplicates(["genome", "accession", "num", "normal", "family"])
    near = neighbor_distance(neighbor_window(chosen.dropDuplicates(["cluster_num", "accession"]), once, size, ("cluster_num",)), "cluster_num", "family")
    out = near.select("cluster_num", "family", _arrangement())
    return out.distinct() if genes.filter(F.contains("accession", F.lit(":"))).limit(1).count() else out


def family_arrangements(clusters: DataFrame, neighbors: DataFrame) -> DataFrame:
    """``cluster_num, family, arrangement``: a row for each distinct ``query:direction:neighbor:direction:distance``."""
    return clusters.join(neighbors, "query").select("cluster_num", "family", _arrangement()).distinct()


def cluster_denominators(clusters: DataFrame, neighbors: DataFrame) -> DataFrame:
    """``cluster_num, num_seqs, num_with_neighbors``."""
    some = neighbors.select("query", F.lit(1).alias("_n")).distinct()
    return clusters.join(some, "query", "left").groupBy("cluster_num").agg(F.countDistinct("query").alias("num_seqs"), F.countDistinct(F.when(F.col("_n") == 1, F.col("query"))).alias("num_with_neighbors"))


def cooccurrence(clusters: DataFrame, neighbors: DataFrame, threshold: float = 0.0, strict: bool = False) -> DataFrame:
    """Share of a cluster's queries with neighbours that have the family nearby, cut to two decimals.

    Clusters with fewer than two queries go; so do shares below the threshold (``strict``: at it).
    Neighbours are evaluated once and written to the shared folder.
    """
    stage = Staging(neighbors.sparkSession, "cooccurrence")
    near = neighbors.select("query", "family", F.abs("distance").alias("away"))
    rows = stage.write(clusters.select("cluster_num", "query").join(near, "query", "left").select("cluster_num", "family", "query", "away"), "rows")
    some = F.when(F.col("away").isNotNull(), F.col("query"))
    den = rows.groupBy("cluster_num").agg(F.countDistinct("query").alias("num_seqs"), F.countDistinct(some).alias("num_with_neighbors")).filter("num_seqs >= 2")
    out = _of_families(rows.filter("away IS NOT NULL")).join(den, "cluster_num").withColumn("cooccurrence", cut2(F.col("num_queries"), F.col("num_with_neighbors")))
    return out.filter(F.col("cooccurrence") > threshold if strict else F.col("cooccurrence") >= threshold)


def cooccurrence_table(cooccurrences: DataFrame) -> DataFrame:
    """``family, cluster_num, cooccurrence``: a joined family adds to each of its parts."""
    parts = cooccurrences.select(F.explode(F.split("family", "-")).alias("family"), "cluster_num", "cooccurrence")
    return parts.groupBy("family", "cluster_num").agg((F.round(F.sum(F.col("cooccurrence") * 100)) / 100).alias("cooccurrence"))


def _spokes(*columns: str):
    return F.array_sort(F.collect_list(F.struct(*columns))).alias("spokes")


def cluster_hubs(cooccurrences: DataFrame) -> DataFrame:
    """One hub per cluster with its family spokes."""
    return cooccurrences.filter(F.col("family") != NONE).groupBy("cluster_num", "num_seqs", "num_with_neighbors").agg(F.count("*").alias("num_spokes"), _spokes("family", "num_queries", "num_neighbors", "cooccurrence"))


def family_hubs(cooccurrences: DataFrame) -> DataFrame:
    """One hub per family with its cluster spokes and sums over clusters."""
    return cooccurrences.filter(F.col("family") != NONE).groupBy("family").agg(F.sum("num_queries").alias("num_queries"), F.sum("num_neighbors").alias("num_neighbors"), F.sum("num_with_neighbors").alias("num_with_neighbors"), _spokes("cluster_num", "num_queries", "num_neighbors", "cooccurrence"))


def _details(rows: DataFrame, split: bool) -> DataFrame:
    if split:
        rows = rows.withColumn("family", F.explode(F.split("family", "-")))
    return rows.select("query", "neighbor", "family", "cluster_num", "color", "distance", "query_direction", "direction")


def neighbor_details(clusters: DataFrame, neighbors: DataFrame, colors: DataFrame, cooccurrences: DataFrame | None = None, split: bool = False) -> DataFrame:
    """One row per query and neighbour: cluster, colour, family, distance and directions.

    With ``cooccurrences`` only (cluster, family) pairs above the threshold; ``split`` gives a
    row for each part of a joined family. ``colors``: ``cluster_num, color``.
    """
    rows = clusters.join(neighbors, "query").join(colors, "cluster_num", "left")
    if cooccurrences is not None:
        rows = rows.join(cooccurrences.select("cluster_num", "family").distinct(), ["cluster_num", "family"], "left_semi")
    return _details(rows, split)


def genome_details(clusters: DataFrame, chosen: DataFrame, genes: DataFrame, colors: DataFrame, cooccurrences: DataFrame | None = None, split: bool = False, size: int = MAX_SIZE) -> DataFrame:
    """:func:`neighbor_details` straight from genes: ``chosen`` without cluster, ``genes`` with ``family``.

    Colours and the families above the threshold go to the queries before the window multiplies
    them. A cluster has few such families, as a query has ``2 * size`` neighbours at most: with a
    threshold of ``t``, ``2 * size / t``.
    """
    colored = clusters.join(colors, "cluster_num", "left")
    carry = ("cluster_num", "color")
    if cooccurrences is not None:
        colored, carry = colored.join(cooccurrences.groupBy("cluster_num").agg(F.collect_set("family").alias("_kept")), "cluster_num"), (*carry, "_kept")
    near = neighbor_window(in_clusters(chosen, colored), genes, size, carry)
    if cooccurrences is not None:
        near = near.filter(F.array_contains("_kept", F.col("family")))
    return _details(neighbor_distance(near, "cluster_num", "color", "family"), split)


def no_family_neighbors(clusters: DataFrame, neighbors: DataFrame) -> DataFrame:
    """``cluster_num, neighbor`` of neighbours without family."""
    return clusters.join(neighbors.filter(F.col("family") == NONE), "query").select("cluster_num", "neighbor").distinct()


def genome_no_family(chosen: DataFrame, genes: DataFrame, size: int = MAX_SIZE) -> DataFrame:
    """:func:`no_family_neighbors` straight from genes: ``chosen`` with ``cluster_num``, ``genes`` with ``family``."""
    near = neighbor_window(chosen, genes.filter(F.col("family") == NONE), size, ("cluster_num",))
    return neighbor_distance(near, "cluster_num").select("cluster_num", "neighbor").distinct()


def shrink_neighborhood(neighbors: DataFrame, size: int) -> DataFrame:
    """A smaller window from a stored larger one."""
    return neighbors.filter(F.abs("distance") <= size)


def _node_attributes(members: DataFrame, chosen: DataFrame, of_nodes: DataFrame) -> DataFrame:
    """:func:`node_neighbor_attributes` with a row ``node, family`` for each neighbour."""
    at = chosen.select(F.col("accession").alias("id"), "genome")
    found = members.join(at, "id", "left").groupBy("node").agg(F.max(F.col("genome").isNotNull()).alias("in_gene_table"), F.array_sort(F.collect_set("genome")).alias("genomes"))
    fams = of_nodes.select(F.col("node").alias("_node"), "family").distinct().groupBy("_node").agg(F.lit(True).alias("_some"), F.array_sort(F.collect_set(F.when(F.col("family") != NONE, F.col("family")))).alias("_f"))
    return found.join(fams, F.col("node").eqNullSafe(F.col("_node")), "left").select(
        "node", "in_gene_table", F.coalesce("_some", F.lit(False)).alias("has_neighbors"), "genomes", F.coalesce("_f", F.array().cast("array<string>")).alias("neighbor_families"))


def node_neighbor_attributes(members: DataFrame, chosen: DataFrame, neighbors: DataFrame) -> DataFrame:
    """Per node: is an id in the gene table, has it neighbours, genome ids, distinct neighbour families. ``members``: ``node, id``."""
    return _node_attributes(members, chosen, members.join(neighbors.select(F.col("query").alias("id"), "family"), "id"))


def genome_node_attributes(members: DataFrame, chosen: DataFrame, genes: DataFrame, size: int = MAX_SIZE) -> DataFrame:
    """:func:`node_neighbor_attributes` straight from genes, which have ``family``."""
    near = neighbor_window(in_clusters(chosen, members.withColumnRenamed("id", "query")), genes, size, ("node",))
    return _node_attributes(members, chosen, neighbor_distance(near, "node", "family"))


def evidence_shape(clusters: DataFrame, neighbors: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per cluster and family a shape by structures and reviewed entries among neighbours. ``evidence``: ``accession, is_reviewed, pdb``."""
    return _shapes(clusters.join(neighbors, "query").join(evidence.withColumnRenamed("accession", "neighbor"), "neighbor", "left"))


def genome_evidence(chosen: DataFrame, genes: DataFrame, evidence: DataFrame, size: int = MAX_SIZE) -> DataFrame:
    """:func:`evidence_shape` straight from genes: ``chosen`` with ``cluster_num``, ``genes`` with ``family``."""
    known = genes.join(evidence.select("accession", "is_reviewed", "pdb"), "accession", "left")
    return _shapes(neighbor_distance(neighbor_window(chosen, known, size, ("cluster_num",)), "cluster_num", "family", "is_reviewed", "pdb"))


def _shapes(rows: DataFrame) -> DataFrame:
    pdb = (F.coalesce(F.col("pdb"), F.lit("")) != "") & (F.col("pdb") != "None")
    out = rows.groupBy("cluster_num", "family").agg(F.count_if(pdb).alias("num_pdb"), F.count_if("is_reviewed").alias("num_reviewed"))
    shape = F.when((F.col("num_pdb") > 0) & (F.col("num_reviewed") > 0), "diamond").when(F.col("num_pdb") > 0, "square").when(F.col("num_reviewed") > 0, "triangle").otherwise("circle")
    return out.withColumn("shape", shape)


def evidence_text(neighbors: DataFrame, evidence: DataFrame) -> DataFrame:
    """``neighbor, evidence``: ``ec:pdb:closest:evalue:status``, where the closest structure is not looked up."""
    text = F.concat_ws(":", F.coalesce("ec", F.lit("")), F.coalesce("pdb", F.lit("")), F.lit("None"), F.lit("None"), F.when(F.coalesce("is_reviewed", F.lit(False)), "SwissProt").otherwise("TrEMBL"))
    return neighbors.select("neighbor").distinct().join(evidence.withColumnRenamed("accession", "neighbor"), "neighbor", "left").select("neighbor", text.alias("evidence"))


def family_names(joined: DataFrame, info: DataFrame, family: str = "family") -> DataFrame:
    """Short and long names of joined families in order, the id where there is none. ``info``: ``family, short_name, long_name``."""
    parts = joined.select(family).distinct().select(family, F.posexplode(F.split(family, "-")).alias("i", "part"))
    known = info.select(F.col("family").alias("part"), "short_name", "long_name")
    short = F.coalesce(F.when(F.col("short_name") != "", F.col("short_name")), "part")
    rows = parts.join(known, "part", "left").select(family, F.struct("i", short.alias("s"), F.coalesce(F.when(F.col("long_name") != "", F.col("long_name")), short).alias("l")).alias("x"))
    one = rows.groupBy(family).agg(F.array_sort(F.collect_list("x")).alias("x"))
    joined = lambda k: F.array_join(F.transform("x", lambda v: v[k]), "-")
    return one.select(family, joined("s").alias("short_names"), joined("l").alias("long_names"))


def annotate_genes(neighbors: DataFrame, annotations: DataFrame) -> DataFrame:
    """Adds organism, taxon, status and description of the query and of the neighbour."""
    of = lambda c, p: annotations.select(F.col("accession").alias(c), *[F.col(x).alias(f"{p}_{x}") for x in ("organism", "taxonomy_id", "status", "description")])
    return neighbors.join(of("query", "query"), "query", "left").join(of("neighbor", "neighbor"), "neighbor", "left")


def diagram_index(clusters: DataFrame, order: str = "query") -> tuple[DataFrame, DataFrame]:
    """Queries numbered from 0 by cluster and order, and the index range of each cluster."""
    rows = dense_index(clusters, "cluster_num", order, "query", name="diagram_index") if order != "query" else dense_index(clusters, "cluster_num", "query", name="diagram_index")
    return rows, rows.groupBy("cluster_num").agg(F.min("diagram_index").alias("first"), F.max("diagram_index").alias("last"))


def seed_index(members: DataFrame) -> DataFrame:
    """Seeds of each cluster by falling member count, with the range of their members. ``members``: ``cluster_num, seed, accession``."""
    sizes = members.groupBy("cluster_num", "seed").agg(F.countDistinct("accession").alias("member_count"))
    w = Window.partitionBy("cluster_num").orderBy(F.desc("member_count"), "seed")
    last = F.sum("member_count").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return sizes.select("cluster_num", "seed", "member_count", (F.row_number().over(w) - 1).alias("seed_index"), (last - F.col("member_count")).alias("first"), (last - 1).alias("last"))


def matched_ids(reverse: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``uniprot_id, query_ids`` (comma list) and the unmatched ids of a reverse lookup."""
    some = reverse.filter("matched").groupBy("uniprot_id").agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("query_ids"))
    return some, reverse.filter("NOT matched").select("id").orderBy("id")


def family_colors(families: DataFrame, colors: DataFrame) -> DataFrame:
    """Colours handed out round-robin to the distinct families in order of name. ``colors``: ``num, color``."""
    n = colors.count()
    numbered = dense_index(families.select("family").filter(F.col("family") != NONE).distinct(), "family", name="_i")
    return numbered.withColumn("num", (F.col("_i") % n + 1).cast("int")).join(colors.select(F.col("num").cast("int").alias("num"), "color"), "num").select("family", "color")
