"""Statistics of edges, sequences and clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.selection import quantiles


def cut2(numerator: Column, denominator: Column) -> Column:
    """A ratio cut (not rounded) to two decimals, from integers; 0 if the denominator is."""
    n, d = numerator.cast("long"), denominator.cast("long")
    return F.when(d != 0, F.floor(100 * n / d) / 100).otherwise(0.0)


def score_statistics(edges: DataFrame, score: str = "alignment_score", approximate: bool = False) -> DataFrame:
    """Edge count and five-number summaries of identity and alignment length for each score.

    Quartiles are exact and interpolated: values are counted, put in order over all tasks
    and picked by rank, so a group of any number of distinct values stays spread.
    ``approximate`` sketches them in one pass instead. Null values don't count in the
    summaries, whose columns are null for a group without any; null scores are a group.
    """
    names = {"pident": "pident", "alignment_length": "al"}
    ends = [f(c).cast("double").alias(f"{p}_{n}") for c, p in names.items() for f, n in ((F.min, "whislo"), (F.max, "whishi"))]
    order = [f"{p}_{n}" for p in names.values() for n in ("whislo", "q1", "med", "q3", "whishi")]
    if approximate:
        sketches = [F.percentile_approx(c, [0.25, 0.5, 0.75]).alias(f"{p}_q") for c, p in names.items()]
        out = edges.groupBy(score).agg(F.count("*").alias("edge_count"), *ends, *sketches)
        quart = {f"{p}_{n}": F.col(f"{p}_q")[i].cast("double") for p in names.values() for i, n in enumerate(("q1", "med", "q3"))}
        return out.withColumns(quart).select(score, "edge_count", *order)
    # One row for each score: joins of these are small.
    out = edges.groupBy(score).agg(F.count("*").alias("edge_count"), *ends)
    for c, p in names.items():
        picked = quantiles(edges, [score], c, {f"{p}_q1": 0.25, f"{p}_med": 0.5, f"{p}_q3": 0.75}).withColumnRenamed(score, "_score")
        out = out.join(picked, F.col(score).eqNullSafe(F.col("_score")), "left").drop("_score")
    return out.select(score, "edge_count", *order)


def cumulative_edge_counts(edges: DataFrame, score: str = "alignment_score") -> DataFrame:
    """Count for each score and running sum from the highest score down; a window over the few scores."""
    counts = edges.groupBy(score).agg(F.count("*").alias("edge_count"))
    return counts.withColumn("cumulative_edge_count", F.sum("edge_count").over(Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)))


def trim_outlying_groups(counts: DataFrame, min_edges: int = 10, min_groups: int = 30, score: str = "alignment_score", count: str = "edge_count") -> DataFrame:
    """Score groups from the first to the last one with enough edges, widened upwards to ``min_groups``."""
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    enough = F.when(F.col(count) >= min_edges, F.col("_i"))
    numbered = counts.withColumn("_i", F.row_number().over(Window.orderBy(score)))
    bounds = numbered.withColumns({"_a": F.min(enough).over(every), "_b": F.max(enough).over(every)})
    first = F.coalesce("_a", F.lit(1))
    last = F.greatest(F.coalesce("_b", F.lit(0)), first + (min_groups - 1))
    return bounds.filter((F.col("_i") >= first) & (F.col("_i") <= last)).drop("_i", "_a", "_b")


def edge_score_histogram(edges: DataFrame, fraction: float = 1.0, score: str = "bitscore") -> DataFrame:
    """Edges for each score cut to an integer, up to the score where the running share reaches ``fraction``."""
    x = F.col(score).cast("double")
    counts = edges.groupBy(F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("long").alias("score")).agg(F.count("*").alias("edges"))
    before = F.sum("edges").over(Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("edges").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return counts.withColumns({"_b": F.coalesce(before, F.lit(0)), "_t": total}).filter(F.col("_b") < fraction * F.col("_t")).select("score", "edges")


def length_histogram(lengths: DataFrame, frac: float = 1.0, fill: bool = False, length: str = "sequence_length") -> DataFrame:
    """Sequences for each length; the ends beyond the central ``frac`` go, gaps are filled with 0 on request."""
    counts = lengths.groupBy(F.col(length).cast("long").alias("length")).agg(F.count("*").alias("count"))
    run = F.sum("count").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("count").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tail = (1.0 - frac) / 2
    kept = counts.withColumns({"_r": run, "_t": total}).filter((F.col("_r") >= tail * F.col("_t")) & (F.col("_r") - F.col("count") <= (1 - tail) * F.col("_t"))).select("length", "count")
    if not fill:
        return kept
    every = kept.agg(F.min("length").alias("a"), F.max("length").alias("b")).filter("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("length"))
    return every.join(kept, "length", "left").select("length", F.coalesce("count", F.lit(0)).alias("count"))


def seed_length_histogram(members: DataFrame, seed: str = "seed", accession: str = "accession", length: str = "sequence_length") -> DataFrame:
    """Length histogram that counts each seed once, with the length of its smallest accession."""
    once = members.groupBy(seed).agg(F.min_by(length, accession).alias(length))
    return once.groupBy(F.col(length).cast("long").alias("length")).agg(F.count("*").alias("count"))


def convergence_ratio(nodes: Column, edges: Column) -> Column:
    """``2E / (N (N - 1))``; 0 where undefined; an error if there are more edges than pairs."""
    most = nodes * (nodes - 1) / 2
    too_many = F.raise_error(F.concat(F.lit("more edges than pairs of nodes: "), edges.cast("string"))).cast("double")
    return F.when(edges > most, F.when((edges == 0) | (nodes <= 1), 0.0).otherwise(too_many)).when(most == 0, 0.0).otherwise(edges / most)


def network_convergence(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row ``nodes, edges, ratio``."""
    n, e = nodes.agg(F.count("*").alias("nodes")), edges.agg(F.count("*").alias("edges"))
    return n.join(F.broadcast(e)).withColumn("ratio", convergence_ratio(F.col("nodes"), F.col("edges")))  # one row each


def node_degrees(edges: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """``node, degree`` from both ends of each edge."""
    return edges.select(F.explode(F.array(q, s)).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def cluster_convergence_ratio(members: DataFrame, degrees: DataFrame) -> DataFrame:
    """Per cluster: sum of node degrees / (n (n - 1)) with n = expanded ids, and node, id and edge counts.

    ``members`` has ``cluster_num, node, id`` (expanded); ids that are nodes carry the degree.
    """
    ids = members.join(degrees.withColumnRenamed("node", "id"), "id", "left")
    out = ids.groupBy("cluster_num").agg(F.countDistinct("node").alias("num_nodes"), F.countDistinct("id").alias("num_ids"), F.coalesce(F.sum("degree"), F.lit(0)).alias("degrees"))
    ratio = F.when(F.col("num_ids") > 1, F.col("degrees") / (F.col("num_ids") * (F.col("num_ids") - 1))).otherwise(0.0)
    return out.select("cluster_num", F.format_string("%.1e", ratio).alias("convergence_ratio"), "num_nodes", "num_ids", F.floor(F.col("degrees") / 2).alias("num_edges"))


def compare_convergence(members: DataFrame, hits: DataFrame, edges: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """Per cluster the ratio from raw hits beside the ratio from edges; 1 where undefined. ``members`` has ``cluster_num, id``."""
    def inside(pairs: DataFrame, name: str) -> DataFrame:
        of = lambda c, k: members.select(F.col("id").alias(c), F.col("cluster_num").alias(k))
        both = pairs.select(F.least(q, s).alias("a"), F.greatest(q, s).alias("b")).filter("a != b").distinct().join(of("a", "ca"), "a").join(of("b", "cb"), "b").filter("ca = cb")
        return both.groupBy(F.col("ca").alias("cluster_num")).agg(F.count("*").alias(name))

    sizes = members.groupBy("cluster_num").agg(F.countDistinct("id").alias("n"))
    most = F.col("n") * (F.col("n") - 1) / 2
    ratio = lambda c: F.when(most > 0, F.coalesce(F.col(c), F.lit(0)) / most).otherwise(1.0)
    return sizes.join(inside(hits, "h"), "cluster_num", "left").join(inside(edges, "e"), "cluster_num", "left").select("cluster_num", "n", ratio("h").alias("hit_ratio"), ratio("e").alias("edge_ratio"))


def neighborhood_connectivity(edges: DataFrame, q: str = "qseqid", s: str = "sseqid", ids: DataFrame | None = None) -> DataFrame:
    """``node, connectivity``: mean degree of the neighbours, cut to two decimals; listed ids without edges get 0."""
    both = edges.select(F.col(q).alias("node"), F.col(s).alias("other")).unionByName(edges.select(F.col(s).alias("node"), F.col(q).alias("other")))
    degrees = node_degrees(edges, q, s)
    sums = both.join(degrees.select(F.col("node").alias("other"), "degree"), "other").groupBy("node").agg(F.sum("degree").alias("sum"), F.count("*").alias("k"))
    out = sums.select("node", cut2(F.col("sum"), F.col("k")).alias("connectivity"))
    if ids is None:
        return out
    return ids.select(F.col(ids.columns[0]).alias("node")).distinct().join(out, "node", "left").select("node", F.coalesce("connectivity", F.lit(0.0)).alias("connectivity"))


#: Colours between which the ramp runs.
RAMP = ((20, 50, 110), (255, 255, 0), (255, 50, 50), (255, 10, 150))


def connectivity_colors(connectivity: DataFrame) -> DataFrame:
    """Adds ``color``, a hex colour on the ramp over the range of ``connectivity``; null connectivity takes the first one.

    The ramp runs through the fixed colours in stretches of equal size. A stretch holds its two
    ends and about a third as many steps between them as the range is wide, the first and last
    of which repeat the ends; each value takes the colour at its share of the range.
    """
    ends = connectivity.agg(F.min("connectivity").alias("low"), F.max("connectivity").alias("high")).first()  # one row
    low, high = int(ends.low or 0), int((ends.high or 0) + 0.5)
    inner = max(int((high - low + 1) / 3 - 0.5), 0)
    size = inner + 2
    at = F.floor((F.col("connectivity") - low) * (size * (len(RAMP) - 1)) / (high - low)) - 1 if high > low else F.lit(0)
    at = F.least(F.greatest(F.coalesce(at, F.lit(0)), F.lit(0)), F.lit(size * (len(RAMP) - 1) - 1))
    share = F.least(F.greatest((F.pmod(at, F.lit(size)) - 1) / max(inner - 1, 1), F.lit(0.0)), F.lit(1.0))
    stretch = (F.floor(at / size) + 1).cast("int")

    def channel(i: int) -> Column:
        a, b = (F.element_at(F.array(*[F.lit(c[i]) for c in colors]), stretch) for colors in (RAMP[:-1], RAMP[1:]))
        return F.floor(a + (b - a) * share)

    return connectivity.withColumn("color", F.format_string("#%02X%02X%02X", channel(0), channel(1), channel(2)))


def network_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row ``num_nodes, num_edges``."""
    return nodes.agg(F.count("*").alias("num_nodes")).join(F.broadcast(edges.agg(F.count("*").alias("num_edges"))))  # one row each


def cluster_stats(clusters: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row: clusters, singletons, nodes and ids. ``clusters``: ``node, component``; ``members``: ``node, id``."""
    nodes = clusters if members is None else clusters.join(members, "node", "left")
    ids = F.lit(1).cast("long") if members is None else F.greatest(F.countDistinct("id"), F.lit(1))
    sizes = nodes.groupBy("component").agg(F.countDistinct("node").alias("nodes"), (F.countDistinct("node") if members is None else ids).alias("ids"))
    return sizes.agg(F.count_if(F.col("ids") > 1).alias("num_clusters"), F.count_if(F.col("ids") <= 1).alias("num_singletons"), F.coalesce(F.sum("nodes"), F.lit(0)).alias("num_nodes"), F.coalesce(F.sum("ids"), F.lit(0)).alias("num_ids"))


def cluster_sizes(ids: DataFrame) -> DataFrame:
    """Ids and distinct seeds of each cluster. ``ids``: ``cluster_num, id, seed90, seed50``."""
    return ids.groupBy("cluster_num").agg(F.countDistinct("id").alias("num_ids"), F.countDistinct("seed90").alias("num_seed90"), F.countDistinct("seed50").alias("num_seed50"))


def cluster_centers(members: DataFrame, degrees: DataFrame) -> DataFrame:
    """Node of highest degree in each cluster, ties to the smaller node. ``members``: ``cluster_num, node``."""
    known = members.join(degrees, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    best = F.min(F.struct((-F.col("degree")).alias("d"), "node")).alias("x")
    return known.groupBy("cluster_num").agg(best).select("cluster_num", F.col("x.node").alias("center"), (-F.col("x.d")).alias("degree"))


def _distinct_in_tree(rows: DataFrame, value: str, name: str, additive: bool) -> DataFrame:
    """``_path, name``: numbers at nodes whose sums over subtrees are counts of distinct values.

    A value counts once at each of its lineages. In order of visit, it counts once too often
    at the lowest common ancestor of each two neighbours, so one is taken off there.
    """
    held = rows.filter(F.col(value).isNotNull()).select("_path", F.col(value).alias("_v")).distinct()
    ones = held.select("_path", F.lit(1).cast("long").alias(name))
    if additive:
        return ones
    pairs = held.withColumn("_before", F.lag("_path").over(Window.partitionBy("_v").orderBy("_path"))).filter("_before IS NOT NULL")
    same = F.zip_with("_path", "_before", lambda a, b: a == b)
    common = F.coalesce(F.array_position(same, False), F.size("_path") + 1) - 1
    return ones.unionByName(pairs.select(F.slice("_path", F.lit(1), common.cast("int")).alias("_path"), F.lit(-1).cast("long").alias(name)))


def taxonomy_tree(rows: DataFrame, ranks: list[str], accession: str = "accession", species: str | None = None, seeds: tuple[str, ...] = (), additive: bool = False) -> DataFrame:
    """Every node of the rank tree: path columns, depth, sequences, species and distinct seeds.

    A missing rank is ``None``; rows without any rank go; each accession counts once, with the
    first of its lineages if it has several. Null seeds don't count. Rows are summed to one for each node before they
    are copied to its ancestors, so copies grow with the tree only. With ``additive``, seeds
    are distinct within each full lineage only and inner nodes add up their children, so that a
    seed under two children counts twice.
    """
    some = F.coalesce(*ranks).isNotNull()
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    one = F.min(F.struct(F.array(*[word(r) for r in ranks]).alias("_path"), word(species or ranks[-1]).alias("_sp"), *seeds)).alias("x")
    rows = rows.filter(some).groupBy(accession).agg(one).select("x.*")
    counts = {"num_sequences": rows.groupBy("_path").agg(F.count("*").alias("num_sequences")), "num_species": _distinct_in_tree(rows, "_sp", "num_species", False)}
    counts |= {f"num_{s}": _distinct_in_tree(rows, s, f"num_{s}", additive) for s in seeds}
    parts = [df.groupBy("_path").agg(*[(F.sum(name) if c == name else F.lit(0).cast("long")).alias(c) for c in counts]) for name, df in counts.items()]
    every = parts[0]
    for df in parts[1:]:
        every = every.unionByName(df)
    sums = [F.sum(c).alias(c) for c in counts]
    nodes = every.groupBy("_path").agg(*sums).select(F.explode(F.transform(F.sequence(F.lit(0), F.size("_path")), lambda i: F.slice("_path", F.lit(1), i))).alias("_path"), *counts)
    tree = nodes.groupBy("_path").agg(*sums)
    return tree.select(*[F.get("_path", F.lit(i)).alias(r) for i, r in enumerate(ranks)], F.size("_path").alias("depth"), *counts)


def family_sizes(members: DataFrame, seeds: DataFrame | None = None, clans: DataFrame | None = None, seed_in_family: bool = False) -> DataFrame:
    """Rows and distinct members of each family (and clan), and distinct seeds.

    ``members``: ``family, accession``; ``seeds``: ``accession, seed50, seed90``; ``clans``:
    ``family, clan``. With ``seed_in_family`` a seed counts only if it is in the family too.
    """
    rows = members.select("family", "accession")
    if clans is not None:
        rows = rows.unionByName(rows.join(clans, "family").select(F.col("clan").alias("family"), "accession"))
    counts = [F.count("*").alias("num_rows"), F.countDistinct("accession").alias("num_members")]
    if seeds is None:
        return rows.groupBy("family").agg(*counts)
    rows = rows.join(seeds, "accession", "left")
    if seed_in_family:
        own = rows.select("family", F.col("accession").alias("_s")).distinct()
        for c in ("seed50", "seed90"):
            found = own.withColumnRenamed("_s", c).withColumn(f"_{c}", F.lit(True))
            rows = rows.join(found, ["family", c], "left").withColumn(c, F.when(F.col(f"_{c}"), F.col(c))).drop(f"_{c}")
    return rows.groupBy("family").agg(*counts, F.countDistinct("seed50").alias("num_seed50"), F.countDistinct("seed90").alias("num_seed90"))
