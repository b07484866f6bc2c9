"""Registered queries where a larger table or another limit once gave other rows than their SQL."""


import random

import duckdb
import pytest

import __spark_entry__ as entry
from kinweave.operators import edges as E
from kinweave.operators import imports as I
from kinweave.operators import neighborhoods as N

DIR = "/root/testdata/sf0.001"
NEAR = ["neighbor_details_above_threshold", "evidence_shape", "neighbor_details", "family_neighbors", "node_neighbor_attributes", "cooccurrence", "cluster_denominators", "family_hubs", "cluster_hubs", "no_family_neighbors", "cooccurrence_table", "with_families"]


def test_edges_over_the_limit_are_counted(spark, rows, monkeypatch):
    monkeypatch.setattr(E, "EDGE_MAX", 5)
    n = entry.queries()["reduce_edges"](spark, DIR).count()
    assert n > 5 and rows(entry.queries()["guard_edge_count"](spark, DIR)) == [(False, n)]
    edges = spark.createDataFrame([("a", "b"), ("a", "c")], "qseqid string, sseqid string")
    assert [rows(E.edge_limit(edges, k)) for k in (1, 2)] == [[(False, 2)], [(True, 2)]]


@pytest.mark.parametrize("name", ["parse_fasta_headers", "import_fasta"])
def test_ids_of_six_digits_stay_apart(spark, tmp_path, name):
    keys = [0, 1, 2, 4, 9_999, 10_000, 10_001, *range(99_996, 100_013), 1_000_000, 1_000_001]
    spark.createDataFrame([(k, f"part {k % 3}", 5 + k % 4) for k in keys], "p_partkey long, p_name string, p_size int").repartition(3).write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')")
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    assert sorted(map(repr, map(tuple, entry.queries()[name](spark, str(tmp_path)).collect()))) == sorted(map(repr, want))


@pytest.fixture(scope="module")
def genomes(spark):
    """Genes of circular and linear genomes of many lengths, with repeated rows; queries with a genome, and their clusters."""
    rnd = random.Random(5)
    genes = [(f"g{g}", f"{rnd.choice(['a', 'a', 'b:'])}{g}.{i}", i, g % 3 == 0, rnd.random() < 0.5, i * 10, i * 10 + 9) for g, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 30, 31, 40, 41]) for i in range(1, n + 1)]
    genes += [g for g in genes if g[0] == "g9"][:2] + [g for g in genes if g[:3] == ("g11", genes[-90][1], genes[-90][2])] + [g for g in genes if g[0] == "g13" and g[2] == 20] * 70
    genes = spark.createDataFrame(genes, "genome string, accession string, num int, linear boolean, normal boolean, start int, stop int")
    families = spark.createDataFrame([(r.accession, f"F{rnd.randrange(3)}") for r in genes.select("accession").distinct().orderBy("accession").collect() if rnd.random() < 0.8], "accession string, family string")
    queries = genes.select("accession").distinct()
    clusters = queries.selectExpr("accession AS query", "cast(crc32(accession) % 9 AS int) AS cluster_num").unionByName(spark.createDataFrame([("unknown", 1), ("unknown", 99)], "query string, cluster_num int"))
    return genes, families, N.choose_genome(queries, genes), clusters


@pytest.mark.parametrize("size", [1, 3, 5])
def test_windows_equal_plain_ones(spark, rows, genomes, size):
    genes, _, chosen, _ = genomes
    want = []
    held = genes.collect()
    for c in chosen.collect():
        low, high, wraps = c.num - size, c.num + size, not c.linear and size < c.max_num
        want += [(c.accession, g.accession, g.num) for g in held if g.genome == c.genome and (low <= g.num <= high or wraps and low < 1 and g.num >= c.max_num + low or wraps and high > c.max_num and g.num <= high - c.max_num)]
    assert rows(N.neighbor_window(chosen, genes, size).select("query", "accession", "num")) == sorted(want, key=repr)


@pytest.mark.parametrize("size", [3, 20])
def test_arrangements_straight_from_genes(rows, genomes, size):
    genes, families, chosen, clusters = genomes
    near = N.with_families(N.neighbor_distance(N.neighbor_window(chosen, genes, size)), families)
    got = N.genome_arrangements(N.in_clusters(chosen, clusters.unionByName(clusters)), N.genes_with_families(genes, families), size)
    assert rows(got) == rows(N.family_arrangements(clusters, near))


def moved_above_the_window(df) -> int:
    """Exchanges that take rows of a window, by the plan's text: those before the first join on buckets."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("_bucket#")].count("Exchange")


def test_neighbours_are_not_shuffled(spark):
    assert moved_above_the_window(entry.queries()["family_arrangements"](spark, DIR)) == 0


def test_counts_straight_from_genes(rows, genomes):
    genes, families, chosen, clusters = genomes
    named = N.genes_with_families(genes, families)
    for size in (3, 20):
        near = N.with_families(N.neighbor_distance(N.neighbor_window(chosen, genes, size)), families)
        assert rows(N.genome_families(N.in_clusters(chosen, clusters), named, size)) == rows(N.family_neighbors(clusters, near))
        order = ["cluster_num", "family", "num_queries", "num_neighbors", "average_distance", "median_distance", "num_seqs", "num_with_neighbors", "cooccurrence"]
        for share, strict in ((0.0, False), (0.5, True)):
            assert rows(N.genome_cooccurrence(clusters, chosen, named, share, strict, size).select(order)) == rows(N.cooccurrence(clusters, near, share, strict).select(order))


def test_counts_of_a_large_cluster_are_dealt(rows, genomes, monkeypatch):
    genes, families, chosen, clusters = genomes
    monkeypatch.setattr(N, "LOT", 7)
    one = clusters.selectExpr("query", "1 AS cluster_num")
    near = N.with_families(N.neighbor_distance(N.neighbor_window(chosen, genes, 3)), families)
    assert rows(N.genome_families(N.in_clusters(chosen, one), N.genes_with_families(genes, families), 3)) == rows(N.family_neighbors(one, near))


def test_rows_straight_from_genes(spark, rows, genomes):
    genes, families, chosen, clusters = genomes
    named, size = N.genes_with_families(genes, families), 4
    near = N.with_families(N.neighbor_distance(N.neighbor_window(chosen, genes, size)), families)
    colors = spark.createDataFrame([(1, "#1"), (3, "#3")], "cluster_num int, color string")
    some = N.cooccurrence(clusters, near, 0.4)
    for kept in (None, some):
        assert rows(N.genome_details(clusters, chosen, named, colors, kept, size=size)) == rows(N.neighbor_details(clusters, near, colors, kept))
    placed = N.in_clusters(chosen, clusters)
    assert rows(N.genome_no_family(placed, named, size)) == rows(N.no_family_neighbors(clusters, near))
    evidence = genes.selectExpr("accession", "num % 2 = 0 AS is_reviewed", "CASE WHEN num % 3 = 0 THEN '1X' WHEN num % 3 = 1 THEN 'None' END AS pdb").distinct()
    assert rows(N.genome_evidence(placed, named, evidence, size)) == rows(N.evidence_shape(clusters, near, evidence))
    members = clusters.selectExpr("CASE WHEN cluster_num < 8 THEN concat('N', cluster_num) END AS node", "query AS id")
    assert rows(N.genome_node_attributes(members, chosen, named, size)) == rows(N.node_neighbor_attributes(members, chosen, near))


def moved(spark, df, what) -> int:
    """Rows or bytes that go through shuffles when a result is made."""
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()

    def stages():
        found = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(x.stageId(), x.attemptId()): getattr(x, what)() for x in map(found.apply, range(found.size()))}

    before = stages()
    df().write.format("noop").mode("overwrite").save()
    return sum(n for k, n in stages().items() if k not in before)


@pytest.mark.parametrize("name", NEAR)
def test_neighbours_are_counted_where_they_are_made(spark, name):
    """Fewer rows are moved than there are neighbours; where the window is made twice, than twice as many."""
    near = entry.queries()["neighbor_distance"](spark, DIR).count() * (2 if name == "neighbor_details_above_threshold" else 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert moved(spark, lambda: entry.queries()[name](spark, DIR), "shuffleWriteRecords") < near
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_member_lists_are_moved_once_for_many_ids(spark, rows, monkeypatch):
    monkeypatch.setattr(I, "SERVED", 100)
    seeds = spark.range(2000).selectExpr("concat('A', id) AS accession", "concat('A', id % 2) AS seed50", "CASE WHEN id % 10 != 3 THEN concat('A', id % 10) END AS seed90")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert moved(spark, lambda: I.seed_members(seeds.select("accession"), seeds), "shuffleWriteBytes") < 1_000_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r.id: (len(r.members50), len(r.members90), r.seeds90) for r in I.seed_members(seeds.select("accession"), seeds).collect()}
    assert len(got) == 2000 and got["A12"] == (1000, 200, ["A0", "A2", "A4", "A6", "A8"]) and got["A13"] == (1000, 0, ["A1", "A5", "A7", "A9"]) and got["A7"] == (1000, 200, ["A1", "A5", "A7", "A9"])


@pytest.mark.parametrize("served", [1, 2, 1000])
def test_seed_members_of_missing_and_empty_seeds(spark, rows, monkeypatch, served):
    monkeypatch.setattr(I, "SERVED", served)
    seeds = spark.createDataFrame([("", "", ""), ("a", "", None), ("b", None, ""), ("c", None, None), (None, "d", "d"), ("e", "d", "")], "accession string, seed50 string, seed90 string")
    got = rows(I.seed_members(spark.createDataFrame([(x,) for x in ["", "a", "b", "c", "d", "e", "?"]], "id string"), seeds))
    assert got == [("", ["", "a"], ["", "b", "e"], [""]), ("?", [], [], []), ("a", ["", "a"], [], [""]), ("b", [], ["", "b", "e"], []), ("c", [], [], []), ("d", ["e"], [], ["", "d"]), ("e", ["e"], ["", "b", "e"], ["", "d"])]


@pytest.mark.parametrize("known", [0, 100])
def test_edges_of_unknown_ends_are_not_moved(spark, rows, monkeypatch, known):
    monkeypatch.setattr(E, "KNOWN", known)
    members = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c"), ("c", None), (None, "x")], "representative string, member string")
    edges = spark.range(5000).selectExpr("concat('q', id) AS qseqid", "'a' AS sseqid", "1.0D AS bitscore").unionByName(spark.createDataFrame([("a", "c", 2.0), ("a", "a", 3.0), (None, "a", 4.0), ("c", "a", 5.0), ("c", "a", 5.0)], "qseqid string, sseqid string, bitscore double"))
    got = rows(E.demultiplex(edges, members))
    assert [x for x in got if None not in x] == [("a", "b", 3.0), ("a", "c", 2.0), ("b", "c", 2.0), ("c", "a", 5.0), ("c", "a", 5.0), ("c", "b", 5.0), ("c", "b", 5.0)] and len(got) == 13
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = moved(spark, lambda: E.demultiplex(edges, members), "shuffleWriteRecords")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (n < 1000) == (known > 0)
