"""Queries of genome neighbourhoods over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.operators import neighborhoods as N
from kinweave.plans.views import oracle, table, view

QUERIES, ORACLES = {}, {}
SIZE = N.MAX_SIZE


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = oracle(sql)
        return f

    return add


def _genes(spark, d):
    return view(spark, d, "genes").drop("family")


def _chosen(spark, d):
    return N.choose_genome(view(spark, d, "asked"), _genes(spark, d))


def _plain(spark, d):
    return N.neighbor_distance(N.neighbor_window(_chosen(spark, d), _genes(spark, d), SIZE))


def _named(spark, d):
    """Genes with their families, joined before the window multiplies them."""
    return N.genes_with_families(_genes(spark, d), view(spark, d, "genes").filter("family != 'error'").select("accession", "family"))


def _clusters(spark, d):
    return view(spark, d, "asked").select(F.col("accession").alias("query"), "cluster_num")


def _placed(spark, d):
    """Chosen genes with their cluster."""
    return N.in_clusters(_chosen(spark, d), _clusters(spark, d))


def _colors(spark, d):
    return view(spark, d, "colors").select(F.col("num").alias("cluster_num"), "color")


def _cooc(spark, d):
    return N.genome_cooccurrence(_clusters(spark, d), _chosen(spark, d), _named(spark, d), 0.3, size=SIZE)


@query("SELECT genome, accession, num, linear, normal, start, stop, max_num, max_stop FROM chosen")
def choose_genome(spark, d):
    return _chosen(spark, d)


@query("SELECT query, neighbor, genome, num FROM near")
def neighbor_window(spark, d):
    w = N.neighbor_window(_chosen(spark, d), _genes(spark, d), SIZE)
    return w.select("query", F.col("accession").alias("neighbor"), "genome", "num")


@query("SELECT query, genome, neighbor, num, distance, rel_start, rel_stop, seq_len, direction, query_direction, type FROM neighbors")
def neighbor_distance(spark, d):
    return _plain(spark, d)


@query("SELECT accession, array_to_string(list_sort(list(DISTINCT family)), '-') AS family FROM fams GROUP BY accession")
def gene_families(spark, d):
    return N.gene_families(view(spark, d, "fams"))


@query("SELECT * FROM neighbors")
def with_families(spark, d):
    return N.neighbor_distance(N.neighbor_window(_chosen(spark, d), _named(spark, d), SIZE), "family")


@query("SELECT q.accession AS query, CASE WHEN c.accession IS NULL THEN 'nomatch' WHEN c.accession NOT IN (SELECT query FROM neighbors) THEN 'noneighbor' ELSE 'ok' END AS status, CASE WHEN c.num IS NOT NULL THEN CAST((CASE WHEN c.num - 20 < 1 THEN 1 ELSE 0 END) | (CASE WHEN c.num + 20 > c.max_num THEN 2 ELSE 0 END) AS INT) END AS edge FROM (SELECT accession FROM asked UNION ALL SELECT 'E-none') q LEFT JOIN chosen c USING (accession)")
def query_status(spark, d):
    asked = view(spark, d, "asked").select("accession")
    extra = spark.range(1).select(F.lit("E-none").alias("accession"))
    return N.query_status(asked.unionByName(extra), _chosen(spark, d), _plain(spark, d), SIZE)


@query("SELECT * FROM famnb")
def family_neighbors(spark, d):
    return N.genome_families(_placed(spark, d), _named(spark, d), SIZE)


@query("SELECT DISTINCT cluster_num, family, concat_ws(':', query, query_direction, neighbor, direction, distance) AS arrangement FROM clustered JOIN neighbors USING (query)")
def family_arrangements(spark, d):
    return N.genome_arrangements(_placed(spark, d), _named(spark, d), SIZE)


@query("SELECT * FROM denom")
def cluster_denominators(spark, d):
    return N.cluster_denominators(_clusters(spark, d), _plain(spark, d))


@query("SELECT * FROM cooc")
def cooccurrence(spark, d):
    return _cooc(spark, d)


@query("SELECT family, cluster_num, round(sum(cooccurrence * 100)) / 100 AS cooccurrence FROM cooc GROUP BY family, cluster_num")
def cooccurrence_table(spark, d):
    return N.cooccurrence_table(_cooc(spark, d))


@query("SELECT cluster_num, num_seqs, num_with_neighbors, count(*) AS num_spokes, string_agg(family, ',' ORDER BY family) AS families FROM cooc WHERE family <> 'none' GROUP BY cluster_num, num_seqs, num_with_neighbors")
def cluster_hubs(spark, d):
    return N.cluster_hubs(_cooc(spark, d)).withColumn("families", F.array_join(F.transform("spokes", lambda s: s["family"]), ",")).drop("spokes")


@query("SELECT family, CAST(sum(num_queries) AS BIGINT) AS num_queries, CAST(sum(num_neighbors) AS BIGINT) AS num_neighbors, CAST(sum(num_with_neighbors) AS BIGINT) AS num_with_neighbors, count(*) AS num_spokes FROM cooc WHERE family <> 'none' GROUP BY family")
def family_hubs(spark, d):
    return N.family_hubs(_cooc(spark, d)).withColumn("num_spokes", F.size("spokes").cast("long")).drop("spokes")


@query("SELECT n.query, n.neighbor, n.family, c.cluster_num, color, distance, query_direction, direction FROM clustered c JOIN neighbors n USING (query) LEFT JOIN colors ON num = c.cluster_num".replace("ON num =", "ON colors.num ="))
def neighbor_details(spark, d):
    return N.genome_details(_clusters(spark, d), _chosen(spark, d), _named(spark, d), _colors(spark, d), size=SIZE)


@query("SELECT n.query, n.neighbor, n.family, c.cluster_num, color, distance, query_direction, direction FROM clustered c JOIN neighbors n USING (query) JOIN cooc o ON o.cluster_num = c.cluster_num AND o.family = n.family LEFT JOIN colors ON colors.num = c.cluster_num")
def neighbor_details_above_threshold(spark, d):
    return N.genome_details(_clusters(spark, d), _chosen(spark, d), _named(spark, d), _colors(spark, d), _cooc(spark, d), split=True, size=SIZE)


@query("SELECT DISTINCT cluster_num, neighbor FROM clustered JOIN neighbors USING (query) WHERE family = 'none'")
def no_family_neighbors(spark, d):
    return N.genome_no_family(_placed(spark, d), _named(spark, d), SIZE)


@query("SELECT query, neighbor, distance FROM neighbors WHERE abs(distance) <= 2")
def shrink_neighborhood(spark, d):
    return N.shrink_neighborhood(_plain(spark, d), 2).select("query", "neighbor", "distance")


@query("""SELECT 'N' || cluster_num AS node, true AS in_gene_table, true AS has_neighbors, list_sort(list(DISTINCT genome)) AS genomes, list_sort(list(DISTINCT family) FILTER (family <> 'none')) AS neighbor_families FROM clustered JOIN neighbors USING (query) GROUP BY cluster_num""")
def node_neighbor_attributes(spark, d):
    members = _clusters(spark, d).select(F.concat(F.lit("N"), "cluster_num").alias("node"), F.col("query").alias("id"))
    return N.genome_node_attributes(members, _chosen(spark, d), _named(spark, d), SIZE)


_EV = "(SELECT concat('E', event_id) AS accession, event_id % 11 = 0 AS is_reviewed, CASE WHEN event_id % 7 = 0 THEN concat('1P', event_id % 90) WHEN event_id % 2 = 0 THEN 'None' END AS pdb, concat('1.', event_id % 6) AS ec FROM events)"


def _evidence(spark, d):
    e = F.col("event_id")
    return table(spark, d, "events").select(F.concat(F.lit("E"), e).alias("accession"), (e % 11 == 0).alias("is_reviewed"), F.when(e % 7 == 0, F.concat(F.lit("1P"), e % 90)).when(e % 2 == 0, "None").alias("pdb"), F.concat(F.lit("1."), e % 6).alias("ec"))


@query(f"SELECT *, CASE WHEN num_pdb > 0 AND num_reviewed > 0 THEN 'diamond' WHEN num_pdb > 0 THEN 'square' WHEN num_reviewed > 0 THEN 'triangle' ELSE 'circle' END AS shape FROM (SELECT cluster_num, family, count(*) FILTER (pdb <> 'None') AS num_pdb, count(*) FILTER (is_reviewed) AS num_reviewed FROM clustered JOIN neighbors USING (query) JOIN {_EV} e ON e.accession = neighbor GROUP BY cluster_num, family)")
def evidence_shape(spark, d):
    return N.genome_evidence(_placed(spark, d), _named(spark, d), _evidence(spark, d).drop("ec"), SIZE)


@query(f"SELECT DISTINCT neighbor, concat(ec, ':', coalesce(pdb, ''), ':None:None:', CASE WHEN is_reviewed THEN 'SwissProt' ELSE 'TrEMBL' END) AS evidence FROM neighbors JOIN {_EV} e ON e.accession = neighbor")
def evidence_text(spark, d):
    return N.evidence_text(_plain(spark, d), _evidence(spark, d))


@query("SELECT DISTINCT concat(p_brand, '-', p_type) AS family, concat(lower(p_brand), '-', p_type) AS short_names, concat('Long ', p_brand, '-', p_type) AS long_names FROM part")
def family_names(spark, d):
    p = table(spark, d, "part")
    info = p.select(F.col("p_brand").alias("family"), F.lower("p_brand").alias("short_name"), F.concat(F.lit("Long "), "p_brand").alias("long_name")).distinct()
    return N.family_names(p.select(F.concat_ws("-", "p_brand", "p_type").alias("family")), info)


_AN = "(SELECT concat('E', event_id) AS accession, concat('O', user_id) AS organism, user_id AS taxonomy_id, event_type AS status, props AS description FROM events)"


@query(f"SELECT n.query, neighbor, a.organism AS query_organism, a.taxonomy_id AS query_taxonomy_id, a.status AS query_status, a.description AS query_description, b.organism AS neighbor_organism, b.taxonomy_id AS neighbor_taxonomy_id, b.status AS neighbor_status, b.description AS neighbor_description FROM neighbors n JOIN {_AN} a ON a.accession = n.query JOIN {_AN} b ON b.accession = neighbor")
def annotate_genes(spark, d):
    a = table(spark, d, "events").select(F.concat(F.lit("E"), "event_id").alias("accession"), F.concat(F.lit("O"), "user_id").alias("organism"), F.col("user_id").alias("taxonomy_id"), F.col("event_type").alias("status"), F.col("props").alias("description"))
    return N.annotate_genes(_plain(spark, d).select("query", "neighbor"), a)


@query("SELECT query, cluster_num, row_number() OVER (ORDER BY cluster_num, query) - 1 AS diagram_index FROM clustered")
def diagram_index(spark, d):
    return N.diagram_index(_clusters(spark, d))[0]


@query("SELECT cluster_num, min(i) AS first, max(i) AS last FROM (SELECT cluster_num, row_number() OVER (ORDER BY cluster_num, query) - 1 AS i FROM clustered) GROUP BY cluster_num")
def diagram_ranges(spark, d):
    return N.diagram_index(_clusters(spark, d))[1]


@query("SELECT cluster_num, seed, member_count, row_number() OVER w - 1 AS seed_index, CAST(sum(member_count) OVER w - member_count AS BIGINT) AS first, CAST(sum(member_count) OVER w - 1 AS BIGINT) AS last FROM (SELECT c_nationkey AS cluster_num, seed90 AS seed, count(*) AS member_count FROM seeds JOIN customer ON concat('C', c_custkey) = accession GROUP BY 1, 2) WINDOW w AS (PARTITION BY cluster_num ORDER BY member_count DESC, seed)")
def seed_index(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("cluster_num"), F.concat(F.lit("C"), "c_custkey").alias("accession"))
    out = N.seed_index(c.join(view(spark, d, "seeds"), "accession").select("cluster_num", F.col("seed90").alias("seed"), "accession"))
    return out.withColumn("seed_index", F.col("seed_index").cast("long"))


@query("SELECT uniprot_id, array_to_string(list_sort(list(DISTINCT foreign_id)), ',') AS query_ids FROM foreign_ GROUP BY uniprot_id")
def matched_ids(spark, d):
    looked = view(spark, d, "foreign_").select("uniprot_id", F.col("foreign_id").alias("id"), F.lit(True).alias("matched"))
    return N.matched_ids(looked)[0]


@query("SELECT foreign_id AS id FROM foreign_ WHERE foreign_id_type = 'pdb'")
def unmatched_ids(spark, d):
    looked = view(spark, d, "foreign_").select("uniprot_id", F.col("foreign_id").alias("id"), (F.col("foreign_id_type") != "pdb").alias("matched"))
    return N.matched_ids(looked)[1]


@query("SELECT family, (SELECT color FROM colors WHERE num = i % 12 + 1) AS color FROM (SELECT p_brand AS family, row_number() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM part))")
def family_colors(spark, d):
    return N.family_colors(table(spark, d, "part").select(F.col("p_brand").alias("family")), view(spark, d, "colors"))
