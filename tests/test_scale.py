"""Hubs, large groups, trees and similarity floors against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.functions.selection import quantiles
from kinweave.operators import components as comp
from kinweave.operators import edges as E
from kinweave.operators import neighborhoods as N
from kinweave.operators import similarity
from kinweave.operators import stats as S


def plain_components(edges, nodes=()):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    for n in nodes:
        find(n)
    return sorted((n, find(n)) for n in parent)


@pytest.mark.parametrize("hub", ["least", "most", "none"])
def test_components_with_hubs(spark, rows, monkeypatch, hub):
    monkeypatch.setattr(comp, "HUB_ROWS", 5)
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)] + [(None, 3), (4, None), (7, 7)] + [(i, i + 1) for i in range(400, 440)]
    center = {"least": -1, "most": 1000}.get(hub)
    edges += [(center, i) for i in range(0, 200, 2)] if center is not None else []
    df = spark.createDataFrame(edges * 2, "src long, dst long")
    nodes = spark.createDataFrame([(900,), (900,), (None,)], "node long")
    assert sorted(rows(comp.connected_components(df, nodes=nodes))) == plain_components(edges, [900])


def test_components_of_nothing(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert comp.connected_components(none).count() == 0
    loops = spark.createDataFrame([(1, 1), (None, None)], "src long, dst long")
    assert [tuple(r) for r in comp.connected_components(loops).collect()] == [(1, 1)]


def test_edges_of_a_hub_are_spread(spark, monkeypatch):
    monkeypatch.setattr(comp, "HUB_ROWS", 100)
    from kinweave.functions.staging import Staging

    edges = spark.range(1, 20_001).select(F.col("id").alias("v"), F.lit(0).cast("long").alias("u"))
    lows = comp._minima(edges, Staging(spark, "t"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in comp._with_minima(edges, lows).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 20_000 and len(sizes) > 1 and max(sizes) < 3 * np.median(sizes)


def test_quantiles_equal_numpy(spark):
    rnd = random.Random(2)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(20), rnd.random()])) for _ in range(3000)] + [("one", 5.0), ("none", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in data], "g string, v double").repartition(7)
    got = {r.g: (r.a, r.b, r.c) for r in quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 1.0}).collect()}
    values = defaultdict(list)
    for g, v in data:
        if v is not None:
            values[g].append(v)
    assert got.keys() == values.keys()
    for g, v in values.items():
        assert got[g] == pytest.approx(tuple(np.quantile(v, [0.25, 0.5, 1.0])))
    assert quantiles(df.filter("false"), ["g"], "v", {"a": 0.5}).count() == 0


def test_quantiles_spread_a_large_group(spark):
    df = spark.range(200_000).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    assert [tuple(r) for r in quantiles(df, ["g"], "v", {"m": 0.5, "q": 0.25}).collect()] == [(1, 99_999.5, 49_999.75)]


def test_score_statistics_of_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, 90.0, 10), (1, 90.0, 20), (1, None, 30), (None, 50.0, 5), (2, None, None)], "alignment_score int, pident double, alignment_length int")
    got = {r.alignment_score: r.asDict() for r in S.score_statistics(df).collect()}
    assert (got[1]["edge_count"], got[1]["pident_med"], got[1]["al_q1"], got[1]["al_whishi"]) == (3, 90.0, 15.0, 30.0)
    assert (got[None]["pident_q3"], got[2]["edge_count"], got[2]["pident_med"], got[2]["al_whislo"]) == (50.0, 1, None, None)
    near = {r.alignment_score: r.pident_med for r in S.score_statistics(df, approximate=True).collect()}
    assert near == {1: 90.0, None: 50.0, 2: None}


@pytest.mark.parametrize("additive", [False, True])
def test_taxonomy_tree_equals_plain_counts(spark, rows, additive):
    rnd = random.Random(3)
    pick = lambda n: rnd.choice([None, *"abcd"[:n]])
    data = [(f"A{i}", pick(2), pick(3), pick(4), rnd.choice([None, "s1", "s2", "s3", "s4"])) for i in range(200)]
    data += [("A0", "zz", "zz", "zz", "s9"), (None, "a", "a", "a", "s1")]  # a second lineage of one accession
    df = spark.createDataFrame(data, "accession string, r1 string, r2 string, r3 string, seed string")
    got = S.taxonomy_tree(df, ["r1", "r2", "r3"], seeds=("seed",), additive=additive)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    first = {}
    for a, *ranks, seed in data:
        if any(r is not None for r in ranks):
            path = tuple(r or "None" for r in ranks)
            first[a] = min(first.get(a, (path, seed)), (path, seed), key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    nodes = defaultdict(list)
    for path, seed in first.values():
        for d in range(4):
            nodes[path[:d]].append((path, seed))
    want = []
    for path, held in nodes.items():
        pairs = {(p, s) for p, s in held if s is not None}
        seeds = len(pairs) if additive else len({s for _, s in pairs})
        want.append((*path, *[None] * (3 - len(path)), len(path), len(held), len({p[2] for p, _ in held}), seeds))
    assert rows(got) == sorted(want, key=repr)
    assert S.taxonomy_tree(df.filter("false"), ["r1", "r2"]).count() == 0


def test_cooccurrence_of_hot_families(spark, rows):
    clusters = spark.createDataFrame([(1, "q1"), (1, "q2"), (2, "q3"), (2, "q4"), (3, "q5")], "cluster_num int, query string")
    near = [("q1", "none", -3), ("q1", "none", 1), ("q1", "F", 2), ("q2", "none", 5), ("q3", "F", 1), ("q5", "F", 1)]
    neighbors = spark.createDataFrame(near, "query string, family string, distance long")
    got = rows(N.family_neighbors(clusters, neighbors))
    assert got == [(1, "F", 1, 1, 2.0, 2.0), (1, "none", 2, 3, 3.0, 3.0), (2, "F", 1, 1, 1.0, 1.0), (3, "F", 1, 1, 1.0, 1.0)]
    both = rows(N.cooccurrence(clusters, neighbors).select("cluster_num", "family", "num_seqs", "num_with_neighbors", "cooccurrence"))
    assert both == [(1, "F", 2, 2, 0.5), (1, "none", 2, 2, 1.0), (2, "F", 2, 1, 1.0)]
    assert N.cooccurrence(clusters, neighbors.filter("false")).count() == 0


def plain_similarity(texts, k, shingle, floor):
    sets = {i: {tuple(w[j : j + shingle]) for j in range(len(w) - shingle + 1)} for i, t in texts for w in [(t or "").lower().split()] if i is not None}
    out = []
    for a, x in sets.items():
        best = sorted((-len(x & y), b) for b, y in sets.items() if b != a and len(x & y) >= floor)[:k]
        out += [(a, b, -n) for n, b in best]
    return sorted(out)


@pytest.mark.parametrize("held,score", [(1000, 0.0), (3, 0.0), (1000, 20.0), (3, 20.1)])
def test_similarity_equals_plain_sets(spark, monkeypatch, held, score):
    rnd = random.Random(4)
    passages = [" ".join(f"p{p}w{i}" for i in range(7)) for p in range(6)]
    texts = [(i, " ".join(rnd.sample(passages, rnd.randrange(0, 4)) + [f"own{i} {i}"])) for i in range(60)] + [(60 + i, passages[0] + " x y z") for i in range(8)] + [(90, None), (91, ""), (92, "A b"), (None, passages[0])]
    df = spark.createDataFrame(texts, "seq_id long, sequence string").repartition(5)
    monkeypatch.setattr(similarity, "LEFT", 7)
    monkeypatch.setattr(similarity, "RIGHT", 11)
    got = E.all_by_all_similarity(df, k=6, max_held=held, min_shared=1, min_score=score).collect()
    floor = next(n for n in range(1, 99) if 10 * math.log2(1 + n) >= score)
    assert sorted((r.qseqid, r.sseqid, r.alignment_length) for r in got) == plain_similarity(texts, 6, 5, floor)
    assert all(r.bitscore >= score for r in got)


def test_least_shared_at_the_boundary():
    assert [E.least_shared(x) for x in (0, 10, 20, 20.1, 50, 50.1)] == [1, 1, 3, 4, 31, 32]
    assert E.least_shared(0, 3) == 3 and E.least_shared(300) == 2**30 - 1
    for s in [x / 7 for x in range(1, 700)]:
        n = E.least_shared(s)
        assert 10 * math.log2(1 + n) >= s and (n == 1 or 10 * math.log2(n) < s)


def test_counts_survive(spark):
    """Degrees of nodes of repeated and null ends."""
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", None)], "qseqid string, sseqid string")
    got = {r.node: r.degree for r in S.node_degrees(df).collect()}
    assert got == Counter({"a": 3, "b": 2, None: 1})
