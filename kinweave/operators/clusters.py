"""Clusters of a network: numbering, expansion, colours and mapping tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.ranking import dense_index


def index_nodes(nodes: DataFrame, edges: DataFrame, node: str = "node", q: str = "qseqid", s: str = "sseqid") -> tuple[DataFrame, DataFrame]:
    """``node_index, node`` (dense, by id) and edges as index pairs; edges with an unknown end go."""
    indexed = dense_index(nodes.select(F.col(node).alias("node")).distinct(), "node", name="node_index")
    of = lambda c, i: indexed.select(F.col("node").alias(c), F.col("node_index").alias(i))
    return indexed.select("node_index", "node"), edges.join(of(q, "source_index"), q).join(of(s, "target_index"), s).select("source_index", "target_index")


#: Attributes that hold the members of a node, and the network they make.
MEMBER_ATTRIBUTES = {"rep-node": "ACC", "uniref50": "UniRef50 Cluster IDs", "uniref90": "UniRef90 Cluster IDs", "uniref100": "UniRef100 Cluster IDs"}


def metanode_members(attributes: DataFrame, kinds: dict[str, str] = MEMBER_ATTRIBUTES) -> DataFrame:
    """``node, member, kind`` from ``node, name, values`` (list attributes); the node itself is a member, ``None`` is none."""
    lists = attributes.filter(F.col("name").isin(list(kinds.values())))
    kind = F.coalesce(*[F.when(F.col("name") == v, k) for k, v in kinds.items()])
    listed = lists.select("node", F.explode("values").alias("member"), kind.alias("kind")).filter("member IS NOT NULL AND member NOT IN ('None', '')")
    own = attributes.select("node").distinct().join(listed.groupBy("node").agg(F.min("kind").alias("kind")), "node", "left")
    return listed.unionByName(own.select("node", F.col("node").alias("member"), F.coalesce("kind", F.lit("uniprot")).alias("kind"))).distinct()


def component_sizes(components: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """``component, num_nodes, num_seqs, is_singleton``; a node counts at least one sequence. ``sizes``: ``node, node_size``."""
    rows = components.withColumn("node_size", F.lit(1)) if sizes is None else components.join(sizes, "node", "left")
    size = F.greatest(F.coalesce(F.col("node_size"), F.lit(1)), F.lit(1)).cast("long")
    out = rows.groupBy("component").agg(F.count("*").alias("num_nodes"), F.sum(size).alias("num_seqs"))
    return out.withColumn("is_singleton", F.col("num_seqs") <= 1)


def number_clusters(sizes: DataFrame) -> DataFrame:
    """Adds ``cluster_num_by_seq`` and ``cluster_num_by_node`` to components that aren't singletons.

    Numbers fall with the size, ties with the component; the table has a row per component and
    is numbered by ranges, not in one task.
    """
    some = sizes.filter("NOT is_singleton")
    by_seq = dense_index(some, F.desc("num_seqs"), "component", name="cluster_num_by_seq", start=1)
    return dense_index(by_seq, F.desc("num_nodes"), "component", name="cluster_num_by_node", start=1)


def cluster_map(components: DataFrame, numbered: DataFrame) -> DataFrame:
    """``node_label`` with both cluster numbers, sorted."""
    return components.join(numbered, "component").select(F.col("node").alias("node_label"), "cluster_num_by_seq", "cluster_num_by_node").orderBy("cluster_num_by_seq", "node_label")


def cluster_info(numbered: DataFrame) -> DataFrame:
    """Both numbers and both sizes of each cluster."""
    return numbered.select("cluster_num_by_seq", F.col("num_seqs").alias("cluster_size_by_seq"), "cluster_num_by_node", F.col("num_nodes").alias("cluster_size_by_node")).orderBy("cluster_num_by_seq")


def singletons(components: DataFrame, sizes: DataFrame) -> DataFrame:
    """Nodes of components with one sequence at most, sorted."""
    return components.join(sizes.filter("is_singleton").select("component"), "component", "left_semi").select("node").orderBy("node")


def expand_metanodes(clusters: DataFrame, members: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """``cluster_num, node, id``: each node's members, of one or two levels. ``members``, ``second``: ``node, member``."""
    out = clusters.join(members.select("node", "member"), "node", "left").select("cluster_num", "node", F.coalesce("member", "node").alias("id"))
    if second is not None:
        out = out.join(second.select(F.col("node").alias("id"), F.col("member").alias("_m")), "id", "left").select("cluster_num", "node", F.coalesce("_m", "id").alias("id"))
    return out.distinct()


def seeds_per_cluster(ids: DataFrame, seeds: DataFrame) -> DataFrame:
    """``cluster_num, kind, seed``: distinct 90 and 50 seeds of each cluster's ids."""
    rows = ids.select("cluster_num", F.col("id").alias("accession")).join(seeds, "accession")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("seed")) for k in ("seed90", "seed50")])).alias("x")
    return rows.select("cluster_num", kinds).select("cluster_num", "x.kind", "x.seed").filter("seed IS NOT NULL").distinct()


def expand_network_ids(ids: DataFrame, edges: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """``id, cluster_num, num_edges, num_nodes`` of each expanded id. ``ids``: ``cluster_num, node, id``."""
    nodes = ids.select("node", "cluster_num").distinct()
    inside = edges.join(nodes.select(F.col("node").alias(q), F.col("cluster_num").alias("_c")), q).groupBy(F.col("_c").alias("cluster_num")).agg(F.count("*").alias("num_edges"))
    sizes = nodes.groupBy("cluster_num").agg(F.count("*").alias("num_nodes"))
    return ids.select("id", "cluster_num").distinct().join(inside, "cluster_num", "left").join(sizes, "cluster_num").select("id", "cluster_num", F.coalesce("num_edges", F.lit(0)).alias("num_edges"), "num_nodes")


#: Fixed value: colour of clusters beyond the table.
DEFAULT_COLOR = "#6495ED"


def cluster_colors(clusters: DataFrame, colors: DataFrame, num: str = "cluster_num", wrap: bool = False, name: str = "color") -> DataFrame:
    """Adds the colour of the cluster number; beyond the table the default, or around again. ``colors``: ``num, color``."""
    small = colors.select(F.col("num").alias("_num"), F.col("color").alias(name))
    key = F.col(num)
    if wrap:
        key = (F.col(num) - 1) % colors.count() + 1
    out = clusters.withColumn("_k", key).join(small, F.col("_k") == F.col("_num"), "left").drop("_k", "_num")
    return out.withColumn(name, F.when(F.col(num).isNotNull(), F.coalesce(name, F.lit(DEFAULT_COLOR))))


def color_network(components: DataFrame, sizes: DataFrame, numbered: DataFrame, colors: DataFrame) -> DataFrame:
    """Per node: both numbers, colours and counts, or a singleton number."""
    rows = components.join(sizes, "component").join(numbered.select("component", "cluster_num_by_seq", "cluster_num_by_node"), "component", "left")
    for kind in ("seq", "node"):
        rows = cluster_colors(rows, colors, f"cluster_num_by_{kind}", name=f"{kind}_color")
    alone = dense_index(singletons(components, sizes), "node", name="singleton_num", start=1)
    some = lambda c: F.when(~F.col("is_singleton"), F.col(c)).alias(c)
    return rows.join(alone, "node", "left").select("node", "cluster_num_by_seq", "cluster_num_by_node", "seq_color", "node_color", some("num_seqs"), some("num_nodes"), "singleton_num")


def mapping_table(ids: DataFrame, colors: DataFrame, annotations: DataFrame, taxonomy: DataFrame, strip_domain: bool = False) -> DataFrame:
    """``id, cluster_num, cluster_color, taxonomy_id, species`` of all expanded ids, by cluster, then id.

    ``annotations``: ``accession, taxonomy_id``; ``taxonomy``: ``taxonomy_id, species``. With
    ``strip_domain`` annotations are those of the id before ``:start:end``.
    """
    key = F.regexp_replace("id", r":\d+:\d+$", "") if strip_domain else F.col("id")
    rows = cluster_colors(ids.select("id", "cluster_num").distinct(), colors, name="cluster_color").withColumn("accession", key)
    out = rows.join(annotations.select("accession", "taxonomy_id"), "accession", "left").join(taxonomy.select("taxonomy_id", "species"), "taxonomy_id", "left")
    return out.select("id", "cluster_num", "cluster_color", "taxonomy_id", "species").orderBy("cluster_num", "id")


def reviewed_table(ids: DataFrame, annotations: DataFrame) -> DataFrame:
    """``cluster_num, id, description`` of reviewed ids. ``annotations``: ``accession, is_reviewed, description``."""
    known = annotations.filter("is_reviewed").select(F.col("accession").alias("id"), F.regexp_replace("description", r";\s*$", "").alias("description"))
    return ids.select("cluster_num", "id").distinct().join(known, "id").select("cluster_num", "id", "description").orderBy("cluster_num", "id")


def paint_nodes(nodes: DataFrame, mapping: DataFrame, id_col: int = 0, color_col: int = 1, extra: dict[str, int] | None = None, node: str = "node") -> DataFrame:
    """Adds ``color`` and extra columns from a mapping table by the positions of its columns.

    Of several rows of a node the one with the smallest colour, then extra columns, counts; null
    ids and nodes without a row get nulls.
    """
    at = lambda i: F.col(mapping.columns[i])
    shown = F.struct(at(color_col).alias("color"), *[at(i).alias(n) for n, i in (extra or {}).items()])
    chosen = mapping.groupBy(at(id_col).alias(node)).agg(F.min(shown).alias("_x")).select(node, "_x.*")
    return nodes.join(chosen, node, "left")


