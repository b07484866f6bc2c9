import math
import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import edges as E
from kinweave.operators import stats as S

HITS = [
    ("a", "b", 90.0, 30, 50.0), ("B", "A", 80.0, 40, 50.0), ("A", "B", 80.0, 20, 50.0), ("A", "A", 100.0, 99, 99.0),
    ("A", "C", 70.0, 10, 1.0), ("C", "D", 60.0, 5, 20.0), ("C", None, 60.0, 5, 20.0),
]
SCHEMA = "qseqid string, sseqid string, pident double, alignment_length int, bitscore double"


def test_reduction(spark, rows):
    lengths = spark.createDataFrame([("A", 100), ("B", 10), ("C", 1000)], "seqid string, sequence_length long")
    hits = spark.createDataFrame(HITS, SCHEMA)
    out = E.reduce_edges(hits, lengths)
    assert rows(out.select("qseqid", "sseqid", "pident", "alignment_length", "alignment_score")) == [("A", "B", 80.0, 20, 12), ("A", "C", 70.0, 10, -5), ("C", "D", 60.0, 5, None)]
    again = E.best_hit_per_pair(E.canonicalize_pairs(E.drop_self_hits(out)))
    assert rows(again) == rows(out.select(again.columns))
    cut = E.add_alignment_score(E.attach_lengths(out.select(hits.columns), lengths), "trunc")
    assert [r.alignment_score for r in cut.orderBy("qseqid", "sseqid").collect()] == [12, -4, None]
    assert E.reduce_edges(hits.limit(0), lengths).count() == 0


def test_filters(spark, rows):
    edges = spark.createDataFrame([("A", "B", 1.0, 10, 20), ("A", "C", 5.0, 10, 900)], "qseqid string, sseqid string, bitscore double, query_length int, subject_length int")
    assert E.filter_edges(edges, "bitscore", 1, 10).count() == 2
    assert rows(E.filter_edges(edges, "bitscore", 1, 10, 100).select("sseqid")) == [("B",)]
    with pytest.raises(ValueError):
        E.filter_edges(edges, "color", 1)
    ids = spark.createDataFrame([("A",), ("C",)], "id string")
    assert rows(E.filter_edges_by_ids(edges, ids).select("sseqid")) == [("C",)]
    assert E.guard_edge_count(edges, 1)[0] is False and E.guard_edge_count(edges, 1)[1].count() == 0 and E.guard_edge_count(edges, 2)[0]


def test_multiplex_round_trip(spark, rows):
    seqs = spark.createDataFrame([("s1", "MK"), ("s2", "MK"), ("s3", "AA"), ("s4", None)], "seq_id string, sequence string")
    members = E.multiplex(seqs)
    assert ("s1", "s2") in rows(members) and ("s3", "s3") in rows(members)
    edges = spark.createDataFrame([("s1", "s3", 1.0), ("s1", "s1", 2.0), ("s1", "zz", 3.0)], "qseqid string, sseqid string, bitscore double")
    assert rows(E.demultiplex(edges, members)) == [("s1", "s2", 2.0), ("s1", "s3", 1.0), ("s2", "s3", 1.0)]


@pytest.mark.parametrize("nodes,edges,ratio", [(1, 1, 0.0), (5, 2, 0.2), (9825, 17582, 0.000364319), (12, 12, 0.1818181818), (131, 0, 0.0)])
def test_convergence_ratio(spark, nodes, edges, ratio):
    got = spark.range(1).select(S.convergence_ratio(F.lit(nodes), F.lit(edges)).alias("r")).first().r
    assert abs(got - ratio) < 1e-8


def test_convergence_ratio_of_an_impossible_graph(spark):
    with pytest.raises(Exception, match="more edges"):
        spark.range(1).select(S.convergence_ratio(F.lit(5), F.lit(11))).collect()


def test_statistics(spark, rows):
    edges = spark.createDataFrame([(10, 1.0, 1), (10, 3.0, 2), (11, 5.0, 9)], "alignment_score int, pident double, alignment_length int")
    assert rows(S.score_statistics(edges).select("alignment_score", "edge_count", "pident_q1", "al_med")) == [(10, 2, 1.5, 1.5), (11, 1, 5.0, 9.0)]
    assert rows(S.cumulative_edge_counts(edges)) == [(10, 2, 3), (11, 1, 1)]
    star = spark.createDataFrame([("c", x) for x in "abd"], "qseqid string, sseqid string")
    assert rows(S.neighborhood_connectivity(star)) == [("a", 3.0), ("b", 3.0), ("c", 1.0), ("d", 3.0)]
    assert all(len(r.color) == 7 for r in S.connectivity_colors(S.neighborhood_connectivity(star)).collect())
    counts = spark.createDataFrame([(i, 20 if 3 <= i <= 5 else 1) for i in range(50)], "alignment_score int, edge_count long")
    assert [r.alignment_score for r in S.trim_outlying_groups(counts, 10, 4).orderBy("alignment_score").collect()] == [3, 4, 5, 6]


def test_taxonomy_tree(spark, rows):
    data = [("A1", "Bac", "X", "s1", "S"), ("A2", "Bac", None, "s2", "S"), ("A2", "Bac", None, "s2", "S"), ("A3", None, None, "s3", "T")]
    tree = S.taxonomy_tree(spark.createDataFrame(data, "accession string, domain string, kingdom string, sp string, seed50 string"), ["domain", "kingdom"], species="sp", seeds=("seed50",))
    assert rows(tree.select("domain", "kingdom", "depth", "num_sequences", "num_seed50")) == [("Bac", "None", 2, 1, 1), ("Bac", "X", 2, 1, 1), ("Bac", None, 1, 2, 1), (None, None, 0, 2, 1)]


@pytest.mark.parametrize("k,held", [(4, 1000), (4, 5), (40, 5), (250, 2)])
def test_similarity_counts_common_shingles(spark, rows, k, held):
    rnd = random.Random(k + held)
    words = lambda n: [f"w{rnd.randrange(400)}" for _ in range(n)]
    copy, passage, near = words(12), words(9), words(30)
    texts = [copy] * 12 + [words(rnd.randrange(8)) + passage + words(rnd.randrange(8)) for _ in range(14)] + [words(6) for _ in range(3)] + [passage] * 7
    for _ in range(14):
        at = rnd.randrange(30)
        texts.append(near[:at] + words(1) + near[at + 1 :])
    texts += [copy + passage, near + passage, []]
    rnd.shuffle(texts)
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    want = []
    for q, a in enumerate(sets):
        found = sorted((-len(a & b), s) for s, b in enumerate(sets) if s != q and len(a & b) >= 3)[:k]
        want += [(q, s, round(-100.0 * n / (len(a) + len(sets[s]) + n), 6), -n) for n, s in found]
    data = spark.createDataFrame([*((i, " ".join(t)) for i, t in enumerate(texts)), (900, None)], "seq_id int, sequence string")
    got = E.all_by_all_similarity(data, k, max_held=held)
    assert rows(got.select("qseqid", "sseqid", F.round("pident", 6), "alignment_length")) == sorted(want, key=repr)
    assert E.all_by_all_similarity(data.limit(0)).count() == 0


def test_colours_of_a_ramp(spark):
    """Nine steps in each of three stretches between the fixed colours, whose ends stand twice."""
    rows = [(i, float(i)) for i in range(31)] + [(99, None)]
    got = {r.node: r.color for r in S.connectivity_colors(spark.createDataFrame(rows, "node int, connectivity double")).collect()}
    inner = int(31 / 3 - 0.5)
    ramp = []
    for a, b in zip(S.RAMP, S.RAMP[1:], strict=False):
        ramp += [a, *[[int(x + (y - x) * i / (inner - 1)) for x, y in zip(a, b, strict=True)] for i in range(inner)], b]
    for i, x in rows:
        at = max(1, min(len(ramp), math.floor((x or 0) * len(ramp) / 30)))
        assert got[i] == "#%02X%02X%02X" % tuple(ramp[at - 1])
    df = spark.createDataFrame([(3, 3.0)], "node int, connectivity double")
    assert S.connectivity_colors(df).first().color == "#14326E" and S.connectivity_colors(df.limit(0)).count() == 0


def test_running_max(spark):
    from kinweave.functions.ranking import running_max

    rows = [(i, i if i % 7 == 3 else None) for i in range(100)]
    got = {r.n: r.last for r in running_max(spark.createDataFrame(rows, "n int, v int").repartition(5), F.col("v"), "n").collect()}
    assert got == {i: (None if i < 3 else (i - 3) // 7 * 7 + 3) for i in range(100)}
