import random

from kinweave.functions.ranking import dense_index
from kinweave.operators import clusters as C
from kinweave.operators import neighborhoods as N
from kinweave.operators.components import connected_components


def union_find(edges, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        up[rb] = ra
    return sorted((n, min(m for m in nodes if root(m) == root(n))) for n in nodes)


def test_components(spark, rows):
    rnd = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(200, i) for i in range(201, 230)]
    some = [(rnd.randrange(300, 360), rnd.randrange(300, 360)) for _ in range(40)]
    edges = chain + star + some + [(5, 5)]
    nodes = {x for e in edges for x in e} | {999}
    df = spark.createDataFrame([*edges, (None, 3)], "src long, dst long")
    got = connected_components(df, nodes=spark.createDataFrame([(999,), (None,)], "n long"))
    assert rows(got) == sorted(union_find(edges, nodes), key=repr)
    assert connected_components(df.limit(0)).count() == 0


def test_numbers(spark, rows):
    comps = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("x", "x"), ("m", "m")], "node string, component string")
    sizes = C.component_sizes(comps, spark.createDataFrame([("m", 3), ("x", 0)], "node string, node_size int"))
    numbered = C.number_clusters(sizes)
    assert rows(numbered.select("component", "cluster_num_by_seq", "cluster_num_by_node")) == [("a", 2, 1), ("c", 3, 2), ("m", 1, 3)]
    assert rows(C.singletons(comps, sizes)) == [("x",)]
    colors = spark.createDataFrame([(1, "#000001"), (2, "#000002")], "num int, color string")
    assert {r.cluster_num_by_seq: r.color for r in C.cluster_colors(numbered, colors, "cluster_num_by_seq").collect()} == {1: "#000001", 2: "#000002", 3: "#6495ED"}
    assert {r.cluster_num_by_seq: r.color for r in C.cluster_colors(numbered, colors, "cluster_num_by_seq", wrap=True).collect()}[3] == "#000001"


def test_dense_index(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1009 AS k")
    got = [r["index"] for r in dense_index(df, "k").orderBy("k").collect()]
    assert got == list(range(1000))


def genes(spark):
    circular = [("C", f"c{i}", i, False, True, i * 100, i * 100 + 90) for i in range(1, 31)]
    linear = [("L", f"l{i}", i, True, i % 2 == 0, i * 100, i * 100 + 90) for i in range(1, 13)] + [("M", "c2", 1, True, True, 5, 50)]
    return spark.createDataFrame(circular + linear, "genome string, accession string, num int, linear boolean, normal boolean, start int, stop int")


def test_neighborhoods(spark, rows):
    g = genes(spark)
    asked = spark.createDataFrame([("c2",), ("l1",), ("l12",), ("none",)], "accession string")
    chosen = N.choose_genome(asked, g)
    assert rows(chosen.select("accession", "genome")) == [("c2", "C"), ("l1", "L"), ("l12", "L")]
    near = N.neighbor_distance(N.neighbor_window(chosen, g, 3))
    assert sorted(r.distance for r in near.filter("query = 'c2'").collect()) == [-3, -2, -1, 1, 2, 3]
    assert {(r.neighbor, r.distance) for r in near.filter("query = 'c2' AND distance < -1").collect()} == {("c30", -2), ("c29", -3)}
    assert sorted(r.distance for r in near.filter("query = 'l1'").collect()) == [1, 2, 3]
    status = {r.query: (r.status, r.edge) for r in N.query_status(asked, chosen, near, 3).collect()}
    assert status == {"c2": ("ok", 1), "l1": ("ok", 1), "l12": ("ok", 2), "none": ("nomatch", None)}
    fams = spark.createDataFrame([("c3", "PF2"), ("c3", "PF1"), ("l2", "PF1")], "accession string, family string")
    named = N.with_families(near, fams)
    assert {r.family for r in named.filter("neighbor = 'c3'").collect()} == {"PF1-PF2"}
    clusters = spark.createDataFrame([(1, "c2"), (1, "l1"), (2, "l12")], "cluster_num int, query string")
    co = N.cooccurrence(clusters, named)
    assert {(r.cluster_num, r.family): r.cooccurrence for r in co.collect()} == {(1, "PF1-PF2"): 0.5, (1, "PF1"): 0.5, (1, "none"): 1.0}
    assert rows(N.cooccurrence_table(co).filter("family = 'PF1'").select("cooccurrence")) == [(1.0,)]
