"""Resampling, centroid clustering and ring shards against brute force and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinweave.llm import centroids, importance, ring

RUN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def runs(t, most=2):
    w = RUN.findall(lower(t))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def odd_texts(seed=1, n=300):
    rnd = random.Random(seed)
    fixed = [None, "", " \n", "A b", "é-ü x9", "İ ß K", "aaa " * 5000, "x", "Q" * 5000 + " b " + "z" * 70, "\x00a\x7fb"]
    return fixed + ["".join(rnd.choice("abB9 -é漢\n\0") for _ in range(rnd.randrange(90))) for _ in range(n)]


@pytest.mark.parametrize("most", [1, 2, 4])
def test_crcs_of_runs_come_from_prefixes(most):
    texts = odd_texts()
    for column in (pa.array(texts), pa.array(["zz", *texts]).slice(1), pa.array(texts, pa.large_string())):
        n_words, who, bucket = importance.features(column, most, 997)
        want = [(i, zlib.crc32(f.encode()) % 997) for i, t in enumerate(texts) for f in runs(t, most)[1]]
        assert sorted(zip(who.tolist(), bucket.tolist(), strict=True)) == sorted(want)
        assert n_words.tolist() == [runs(t)[0] for t in texts]
    assert not importance.features(pa.array([], pa.string()), most)[1].size


def test_running_crcs_at_any_length():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 65, 4095, 4096, 4097, 70_001):
        data = rnd.integers(0, 256, n).astype(np.uint8)
        states = importance.running_crcs(data)
        assert len(states) == n + 1
        for a, b in [(0, n), (n // 3, n), (n // 2, n // 2), (n // 5, n // 2)]:
            crc = states[b] ^ importance.shifted(states[[a]] ^ importance.ONES, np.array([b - a]))[0] ^ importance.ONES
            assert crc == zlib.crc32(data[a:b].tobytes())


def brute_resample(docs, target, percent=25, least=20, buckets=10_000):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in runs(t)[1])
    s, t = count([x for _, x in docs]), count(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    out = []
    for i, x in docs:
        n, found = runs(x)
        weight = sum(gain(zlib.crc32(f.encode()) % buckets) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fine = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0]))
    for rank, r in enumerate(fine[: len(fine) * percent // 100]):
        r[5] = rank + 1
    return sorted(map(tuple, out), key=repr)


def test_resampling_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(importance, "BYTES", 1000)
    rnd = random.Random(4)
    texts = odd_texts(2, 60) + [" ".join(rnd.choice(["alpha", "Beta", "gamma", "7"]) for _ in range(rnd.randrange(15, 60))) for _ in range(120)]
    docs, target = list(enumerate(texts)), ["alpha beta alpha beta", None, "7 7 7"]
    docs += docs[100:110]  # repeated rows tie
    df = spark.createDataFrame([(i, x, 1, 2.0, "t", 3) for i, x in docs], "doc_id long, text string, rank int, score double, _tie string, n_words int").repartition(5)
    got = importance.resample(df, spark.createDataFrame([(x,) for x in target], "text string"))
    assert set(got.columns) == {"doc_id", "_tie", "n_words", "n_features", "weight", "score", "rank"}
    assert rows(got.select("doc_id", "n_words", "n_features", "weight", "score", "rank")) == brute_resample(docs, target)


def test_resampling_of_nothing_and_null_ids(spark, rows):
    df, none = spark.createDataFrame([(None, "a " * 30), (1, "b " * 30)], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    got = importance.resample(df, none, percent=100).orderBy("rank").collect()
    assert [(r.doc_id, r["rank"]) for r in got] == [(1, 1), (None, 2)]
    assert got[1].score is None
    assert importance.resample(none, df).count() == 0


def plain_kmeans(vectors, k, rounds, seed=1):
    c = np.array([v for _, v in sorted(vectors, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]], object)
    x = np.array([v for _, v in vectors], object)
    for t in range(rounds + 1):
        far = np.array([[sum((a - b) ** 2) for b in c] for a in x], object)
        own = [min(range(len(c)), key=lambda j: (row[j], j)) for row in far]
        if t < rounds:
            for j in range(len(c)):
                if j in own:
                    mine = x[[i for i, o in enumerate(own) if o == j]]
                    c[j] = mine.sum(0) // len(mine)
    total = Counter()
    for i, o in enumerate(own):
        total[o] += far[i][o]
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c.tolist()]
    return sorted([(vectors[i][0], o, far[i][o], total[o], sum(total.values()), digest[o]) for i, o in enumerate(own)], key=repr)


@pytest.mark.parametrize("large", [4, 1 << 25])
def test_clusters_equal_plain_ones(spark, rows, large):
    rnd = random.Random(5)
    vectors = [(i, [rnd.randrange(-large, large) for _ in range(3)]) for i in range(150)] + [(7, [0, 0, 0])] * 3
    df = spark.createDataFrame(vectors, "vec_id long, v array<long>").repartition(4)
    for k, n in ((6, 3), (40, 5), (1, 2)):
        got = centroids.clustered(df, k, n)
        # Rows of one id and different vectors tie by vector.
        assert rows(got) == plain_kmeans(vectors, k, n)


def test_bounds_skip_distances_and_agree(monkeypatch):
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.integers(-50, 50, (400, 8)) + 1000 * rnd.integers(-5, 5, 8) for _ in range(10)]).astype(np.int64)
    history, state, evaluated = [x[rnd.choice(len(x), 10, False)].copy()], (None,) * 3, []
    for _ in range(8):
        cluster, far, seen, n = centroids.assign(x, np.stack(history), *state)
        every = ((x[:, None] - history[-1][None]) ** 2).sum(2)
        assert (cluster == every.argmin(1)).all()
        evaluated.append(n)
        state = cluster, far, seen
        c = history[-1].copy()
        for j in set(cluster.tolist()):
            c[j] = x[cluster == j].sum(0) // (cluster == j).sum()
        history.append(c)
    assert evaluated[0] == len(x) * 10 and min(evaluated[1:]) < len(x)
    # The norm of a displacement is at most the sum of the moves.
    moves = np.sqrt((np.diff(np.stack(history), axis=0) ** 2).sum(2))
    assert (np.sqrt(((history[-1] - history[0]) ** 2).sum(1)) <= moves.sum(0) + 1e-6).all()


def test_clusters_of_odd_rows(spark, rows):
    data = [(1, [1.0, 0.5]), (2, None), (3, [1.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (None, [0.0, -0.51]), (6, [float("inf"), 0.0])]
    df = spark.createDataFrame([(i, v, 9) for i, v in data], "vec_id long, embedding array<float>, cluster int")
    kept = centroids.quantized(df, size=2, scale=2)
    assert rows(kept) == [(1, [2, 1]), (None, [0, -2])]
    assert {(r.vec_id, r.cluster, r.distance) for r in centroids.clustered(kept, 5, 2).collect()} == {(1, 0, 0), (None, 1, 0)}
    assert centroids.clustered(kept.filter("false")).count() == 0
    with pytest.raises(Exception, match="a component is beyond"):
        centroids.quantized(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>"), size=1).collect()


def plain_ring(keys, shards, each):
    """Keys one by one: home keys in order while there is room, then the others clockwise."""
    nodes = sorted((zlib.crc32(f"{s}:{i}".encode()) >> 16, s) for s in range(shards) for i in range(each))
    home = lambda h: next((i for i, (p, _) in enumerate(nodes) if p >= h >> 16), len(nodes))
    bound = [len(keys) // shards + (s < len(keys) % shards) for s in range(shards)]
    placed, load, later = {}, Counter(), []
    for n, (h, _) in enumerate(sorted(keys)):
        s = nodes[home(h) % len(nodes)][1]
        if load[s] < bound[s]:
            placed[n], load[s] = s, load[s] + 1
        else:
            later.append((n, home(h)))
    for n, at in later:
        while load[nodes[at % len(nodes)][1]] >= bound[nodes[at % len(nodes)][1]]:
            at += 1
        s = nodes[at % len(nodes)][1]
        placed[n], load[s] = s, load[s] + 1
    return sorted((i, placed[n]) for n, (_, i) in enumerate(sorted(keys))), len(later)


@pytest.mark.parametrize("shards,each", [(1, 1), (3, 2), (7, 16)])
def test_shards_equal_one_by_one(spark, shards, each):
    rnd = random.Random(6)
    texts = [rnd.choice(["hot", "hot", None, "", *map(str, range(150))]) for _ in range(301)]
    df = spark.createDataFrame([(i, t, 5, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, shard int, _arc string, _place string").repartition(6)
    out = ring.shard(df, shards, each=each)
    assert set(out.columns) == set(df.columns) | {"slot"}
    got = [(r.doc_id, r.shard, r.slot) for r in out.collect()]
    want, moved = plain_ring([(zlib.crc32((t or "").encode()), i) for i, t in enumerate(texts)], shards, each)
    assert sorted((i, s) for i, s, _ in got) == want
    slots = defaultdict(list)
    for _, s, slot in got:
        slots[s].append(slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(len(slots[s]) for s in range(shards)) <= 1
    # Only what is beyond a shard's bound moves.
    demand, bound = Counter(), ring.bounds_of(len(texts), shards)
    for (i, t) in enumerate(texts):
        nodes = ring.nodes(shards, each)
        h = zlib.crc32((t or "").encode()) >> 16
        demand[next((s for p, s in nodes if p >= h), nodes[0][1])] += 1
    assert moved == sum(max(0, demand[s] - bound[s]) for s in range(shards))


def test_shards_of_odd_rows(spark, rows, tmp_path):
    df = spark.createDataFrame([(None, None), (None, None), (1, "a"), (1, "a"), (2, "long " * 50_000)], "doc_id long, text string")
    out = ring.shard(df, 2)
    assert sorted(r["count"] for r in out.groupBy("shard").count().collect()) == [2, 3]
    assert len(set(rows(out.select("shard", "slot")))) == 5
    assert ring.shard(df.filter("false"), 3).count() == 0
    ring.write_shards(out, str(tmp_path / "s"), 2, parts=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert rows(back.select("doc_id", "shard", "slot")) == rows(out.select("doc_id", "shard", "slot"))
    few = ring.shard(df.limit(2), 5)
    assert few.groupBy("shard").count().filter(F.col("count") > 1).count() == 0
    with pytest.raises(ValueError, match="don't fit"):
        ring.nodes(70_000)


def test_one_more_shard_moves_a_part(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    a, b = ring.shard(df, 10), ring.shard(df, 11).withColumnRenamed("shard", "grown")
    moved = a.join(b, "doc_id").filter("shard != grown").count()
    assert moved < 2400  # of which 364 is the least; a plain remainder would move 3636


@pytest.mark.parametrize("large,k", [(1 << 20, 5), (150_000_000, 5), (1 << 29, 3)])
def test_top_k_of_large_components_is_exact(spark, large, k):
    from kinweave.llm import topk

    rnd = random.Random(7)
    data = [(i, [rnd.randrange(-large, large) for _ in range(4)]) for i in range(60)] + [(100 + i, [large - 1, large - 2, large - 3, large - 4 - i % 2]) for i in range(6)]
    df = spark.createDataFrame(data, "vec_id long, v array<long>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.exact_top_k(df, df.filter("vec_id % 20 = 0"), k).collect())
    want = []
    for i, q in data:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in data if j != i)[:k]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == sorted(want)


def test_top_k_beyond_64_bits_says_so(spark):
    from kinweave.llm import topk

    with pytest.raises(Exception, match="don't fit 64 bits"):
        topk.quantized(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")).collect()
    far = spark.createDataFrame([(i, [1 << 40, 1 << 40]) for i in range(3)], "vec_id long, v array<long>")
    with pytest.raises(Exception, match="may not fit 64 bits"):
        topk.exact_top_k(far, far).collect()


def test_quality_rules_keep_clashing_columns(spark):
    from kinweave.llm import quality_rules

    names = ["_key", "_gone", "_counts", "_host", "_text", "n_words", "kept", "rows"]
    df = spark.createDataFrame([(1, "s", "word " * 30, *"abcdefgh"), (2, None, "x " * 200_000, *"abcdefgh"), (3, "s", None, *"abcdefgh")], f"doc_id long, source string, text string, {', '.join(f'{n} string' for n in names)}")
    out = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert all((r._key, r._gone, r._counts, r._host, r._text, r.rows) == ("a", "b", "c", "d", "e", "h") for r in out.values())
    assert [(out[i].n_words, out[i].kept) for i in (1, 2, 3)] == [(30, False), (200_000, False), (0, False)]


def test_mined_rules_do_not_restate_fixed_ones(spark):
    from kinweave.llm import urls

    fixed = [f"http://h{i % 7}.example.net/{'es' if i % 2 else 'fr'}/{i}" for i in range(100)] + [f"http://h{i % 7}.a.com/en/{i}" for i in range(100)]
    fixed += [f"http://bad-{i}.example.com/en/{i}" for i in range(60)] + [f"http://only.example.net/es/{i}" for i in range(60)]
    asked = ["http://h1.example.net/en/1", "http://only.example.net/en/1", "http://h1.example.org/en/1", "http://x.org/es/1", "http://bad-7.b.org/7", None]
    out = {r.url: r.verdict for r in urls.judge(spark.createDataFrame([(u,) for u in fixed + asked], "url string")).collect()}
    assert [out[u] for u in asked] == ["allow", "allow", "allow", "allow", "block", "allow"]
    rules = spark.createDataFrame([(1, ["a"], "block", 0.9), (2, ["a", "b"], "block", 0.9), (3, ["a", "c"], "block", 0.95), (4, ["a", "b", "c"], "allow", 0.9), (5, ["a", "b", "c"], "block", 0.92)], "rule_id long, parts array<string>, verdict string, confidence double")
    assert sorted(r.rule_id for r in urls.without_redundant(rules).collect()) == [1, 3, 4]
    long = urls.judge(spark.createDataFrame([("http://a.net/es/" + "x" * 200_000,), ("http://a.net/es/1",)], "url string"))
    assert {r.verdict for r in long.collect()} == {"block"}


def test_mixing_of_few_large_documents(spark):
    from kinweave.llm import mixing

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mixing.mix(docs).collect()
    taken, target, least = Counter(), {}, {}
    for r in out:
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        if r.size:
            least[r.source] = min(least.get(r.source, 1 << 60), r.size)
        assert 0 <= r.copies <= 3
    assert all(abs(taken[s] - target[s]) <= max(0.01 * target[s], least[s]) for s in least)


def test_targets_of_many_sources_and_repeats(spark):
    from kinweave.functions.staging import Staging
    from kinweave.llm import mixing

    rnd = random.Random(9)
    sizes = {f"s{i:04d}": rnd.choice([0, 1, 5, 1000]) for i in range(500)} | {None: 7}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df, Staging(spark, "t")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, open_, goal, left = {s: i % 3 + 1 for i, s in enumerate(order)}, set(order), {}, sum(sizes.values())
    while True:
        rate = left / sum(weight[x] for x in open_)
        over = {s for s in open_ if rate * weight[s] >= 3 * sizes[s]}
        goal |= {s: 3 * sizes[s] for s in over}
        if not over:
            break
        left, open_ = left - sum(3 * sizes[s] for s in over), open_ - over
    goal |= {s: rate * weight[s] for s in open_}
    assert got == pytest.approx(goal)
    same = spark.createDataFrame([(1, "a b c", "x")] * 400 + [(2, "d " * 50_000, "y")], "doc_id long, text string, source string")
    mixed = mixing.mix(same)
    assert mixed.filter("source = 'x'").agg(F.max("nth"), F.count("*")).first() == (400, 400)
    assert mixing.repeat(same, mixed).count() == mixed.agg(F.sum("copies")).first()[0]


def test_line_dedup_of_a_very_common_line(spark, monkeypatch):
    from kinweave.llm import line_dedup

    monkeypatch.setattr(line_dedup, "HOT_ROWS", 3)
    df = spark.createDataFrame([(i, f"common line\nown line {i}\ncommon line") for i in range(300)], "doc_id long, text string").repartition(8)
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert out[0] == "common line\nown line 0" and all(out[i] == f"own line {i}" for i in range(1, 300))
