"""The corpus operators against brute force, round trips and edge cases."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinweave.functions.staging import Staging
from kinweave.llm import huffman, language, line_dedup, minhash, mixing, packing, quality_model, quality_rules, tokens, topk, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score double"


def frame(spark, texts, source="s"):
    """Documents with extra columns whose names operators use for their own results."""
    return spark.createDataFrame([(i, t, "en", source, 0, "x", 0.0) for i, t in texts], SCHEMA)


def words(rnd, n, vocabulary=200):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=0):
    rnd = random.Random(seed)
    base = words(rnd, 120)
    texts = [words(rnd, rnd.randrange(1, 60)) for _ in range(40)] + [base] * 5
    for _ in range(60):
        w = base.split()
        for _ in range(rnd.randrange(1, 14)):
            w[rnd.randrange(len(w))] = f"w{rnd.randrange(200)}"
        texts.append(" ".join(w))
    texts += [None, "", "  \n\t", "one", "one", "x y", "long " * 3000]
    return list(enumerate(texts))


def ids_of(path, texts, end_id=None):
    """Ids of each text by columns."""
    out = []
    for _, _, ids, counts in tokens.encode_column(path, pa.array(texts, pa.string()), end_id):
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_columns_equal_the_unmodified_tokenizer(name, monkeypatch):
    path, rnd = public_tokenizers.path(name), random.Random(2)
    t = Tokenizer.from_file(path)
    some = [" ", "  ", "\n", "\t", "a", "Ab", "é", "e\u0301", "'s", "12", "!", "İ", "ß", "　", "\x85", "漢", "😀", "\xa0", ",", "word", "Words.", "<|", "|>", "<|ENDOFTEXT|>", "<|endoftext|>", "<|startoftext|>"]
    texts = ["a <|endoftext|> b", "<|endoftext|><|startoftext|>", "", *("".join(rnd.choice(some) for _ in range(rnd.randrange(14))) for _ in range(3000))]
    texts += ["".join(x) for n in range(6) for x in itertools.product([" ", "\n", "a", "\xa0"], repeat=n)]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    monkeypatch.setattr(tokens, "STEP", 50)
    monkeypatch.setattr(tokens, "BYTES", 500)
    monkeypatch.setattr(tokens, "_encoders", {path: tokens.ColumnEncoder(path, most=50)})
    assert ids_of(path, texts) == want
    assert ids_of(path, texts[:500], 7) == [[*x, 7] for x in want[:500]]  # forgets its words before
    assert ids_of(path, [None, ""]) == [[], []] and ids_of(path, [None], 7) == [[7]] and ids_of(path, []) == []
    monkeypatch.setattr(tokens._encoders[path], "plain", False)  # as for files that can't be cut at spaces
    assert ids_of(path, texts[:200]) == want[:200]


def test_plain_pieces_are_not_split_by_the_pattern():
    """ASCII letters or digits, with marks behind them or not, make one word or two; all else goes through the pattern."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, t, split = tokens.ColumnEncoder(path), Tokenizer.from_file(path), []
    pattern = e.split
    e.split = lambda s: split.append(s) or pattern(s)
    plain = ["word", "Word.", "words,", "dogs'", "3,", "42", "end?!", "a^`_", "x--", "word", "Word!", "o'", "a\"]"]
    other = ["don't", "x's", "'s", "'ll", "1a", "a1.", "été.", "a\nb", ".\nOn", "...", "", "a ", "a.é", "٤.", "a\x00", "a\u0301."]
    texts = [" ".join(["first", *plain, *other, *plain]), " ".join(["", *other, "z"]), "alone", "", " ".join(["first.", *reversed(plain)])]
    got = [x for *_, ids, counts in e.encode(pa.array(texts)) for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert [x.tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert not {f" {x}" for x in plain} & set(split)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_columns_equal_the_tokenizer_on_documents(name):
    path = public_tokenizers.path(name)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    assert ids_of(path, texts) == [x.ids for x in Tokenizer.from_file(path).encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_code_lengths_are_limited_and_complete():
    counts = np.zeros(1 << 16, np.int64)
    counts[:30] = [2**i for i in range(30)]
    for limit in (5, 8, 29):
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and sum(2.0 ** -int(x) for x in lengths[lengths > 0]) == 1
    assert (huffman.code_lengths(np.array([0, 5, 0])) == [0, 1, 0]).all()


def test_huffman_round_trip(spark, tmp_path):
    docs = frame(spark, [*corpus(), (None, "null id")])
    path, name = str(tmp_path / "ids"), public_tokenizers.path("byte_bpe_50k.json")
    huffman.write_blocks(docs, name, path, end_id=2)
    t = Tokenizer.from_file(name)
    start, want = 0, []
    for i, text in [(None, "null id"), *corpus()]:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, huffman.digest(spark, path).collect()), key=repr) == sorted(want, key=repr)
    huffman.write_blocks(docs.limit(0), name, path + "0")
    assert huffman.digest(spark, path + "0").count() == 0


def test_packing(spark):
    rnd = np.random.default_rng(0)
    sizes = rnd.integers(0, 4097, 3000)
    pieces = spark.createDataFrame([(int(i), int(s), "x") for i, s in enumerate(sizes)], "piece int, length long, bin string")
    got = packing.pack(pieces).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for v in by.values():
        v.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(v, v[1:], strict=False)) and v[0][0] == 0 and sum(n for _, n in v) <= 4096
    assert len(got) == 3000 and len(by) <= 1.01 * packing.lower_bound(sizes) + 2
    assert packing.pack(pieces.limit(0)).count() == 0
    assert packing.lower_bound(np.array([3000] * 10)) == 10


def test_pieces(spark):
    """Only documents beyond the capacity are cut; ids, starts and lengths equal the tokenizer's."""
    name = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(name)
    texts = [*corpus(), (200, "no way 12 " * 2500), (201, "w " * 4095), (202, "w " * 4096), (203, "w " * 8191), (None, "null id")]
    got = defaultdict(dict)
    for r in packing.pieces_of(frame(spark, texts), name, end_id=1).collect():
        got[r.doc_id][r.piece] = r
    for i, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = [got[i][k] for k in range(len(got[i]))]
        assert [r.start for r in pieces] == list(range(0, len(ids), 4096))
        assert [np.frombuffer(r.ids, "<u4").tolist() for r in pieces] == [ids[r.start : r.start + 4096] for r in pieces]
        assert [r.length for r in pieces] == [len(ids[r.start : r.start + 4096]) for r in pieces]
    assert [len(got[i]) for i in (200, 201, 202, 203)] == [3, 1, 2, 2]


def brute_components(texts, size, percent):
    sets = {}
    for i, t in texts:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("small", [3, 32])
def test_near_duplicates(spark, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL", small)
    texts = corpus()
    got = minhash.near_duplicates(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 2, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("repeated", [False, True])
def test_the_edge_of_a_large_group_does_not_meet_all_of_it(spark, monkeypatch, repeated):
    """Copies with up to 6 words of 150 replaced, and 10 to 14 in every tenth, which are similar to few or to no others."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(400):
        copy = list(base)
        for at in rng.sample(range(150), rng.randint(10, 14) if i % 10 == 0 else rng.randint(1, 6)):
            copy[at] = rng.choice(["left", "right", f"own{i}-{at}"])
        texts.append((i, " ".join(copy)))
    late, put = [], Staging.write

    def write(stage, df, name, *rest):
        out = put(stage, df, name, *rest)
        if name == "late":
            late.append(out.count())
        return out

    monkeypatch.setattr(Staging, "write", write)
    rows = [*texts, *((i + 1000 * (i % 3), t) for i, t in texts[::5])] if repeated else texts
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    want = brute_components(list(dict(rows).items()), 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) > 5
    assert sum(late) < 2 * len(texts)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    got = minhash.near_duplicates(frame(spark, [(None, "a b c"), (1, "a b c"), (1, "a b c")])).collect()
    assert sorted((repr(r.doc_id), r.kept) for r in got) == [("1", True), ("1", True), ("None", True)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_edit_distance_and_segments(spark, tau):
    rnd, pairs = random.Random(tau), []
    for _ in range(300):
        a = "".join(rnd.choice("abcé😀 ") for _ in range(rnd.randrange(40)))
        b = list(a)
        for _ in range(rnd.randrange(5)):
            b[rnd.randrange(len(b) + 1) : rnd.randrange(len(b) + 1) + 1] = rnd.choice(["", "a", "é", "bb"])
        pairs.append((a, "".join(b)))
    keys = lambda c: F.transform(line_dedup.segment_keys(F.col(c), F.length(c), tau), lambda k: k["key"])
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.within(F.col("a"), F.col("b"), tau).alias("w"), F.arrays_overlap(keys("a"), keys("b")).alias("met"))
    for r in df.collect():
        near = distance(r.a, r.b) <= tau
        assert r.w == near
        assert not near or r.met or min(len(r.a), len(r.b)) <= tau


def brute_lines(texts, tau, least):
    first = {}
    for i, t in sorted(x for x in texts if x[1] is not None):
        for line in t.split("\n"):
            if WORD.search(line):
                first.setdefault(line, i)
    long_ = [x for x in first if len(x) >= least]
    lost = {b for b in long_ for a in long_ if first[a] < first[b] and abs(len(a) - len(b)) <= tau and distance(a, b) <= tau}
    out = {}
    for i, t in texts:
        seen, keep = set(), []
        for line in (t or "").split("\n"):
            stays = line not in first or (line not in lost and first[line] == i and line not in seen)
            seen.add(line)
            keep += [line] if stays else []
        out[i] = None if t is None else "\n".join(keep)
    return out


@pytest.mark.parametrize("tau,small", [(1, 64), (1, 2), (2, 64), (2, 2)])
def test_line_dedup(spark, monkeypatch, tau, small):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    rnd = random.Random(5)
    base = [f"line number {i} of a template with many words in it" for i in range(6)]
    texts = [(0, f"{base[0]}\n{base[0]}x\nshort\n\n \nshort")]  # near lines that begin in one document
    for i in range(1, 40):
        lines = []
        for line in rnd.sample(base, 3) + ["short", "", f"an own line of document {i * 7919 % 1000:05d} that stays"]:
            at = rnd.randrange(len(line) + 1)
            lines.append(line[:at] + rnd.choice(["", "", "x", "y", "zz"]) + line[at + rnd.randrange(2) :])
        texts.append((i, "\n".join(lines + lines[:1])))
    texts += [(98, None), (99, "")]
    docs = frame(spark, texts).withColumns({c: F.lit(1) for c in ("n_lines", "_key", "_gone", "h")})
    out = line_dedup.dedup_lines(docs, tau, 20)
    assert sorted(out.columns) == sorted([*docs.columns, "n_kept"])
    assert {r.doc_id: r.text for r in out.collect()} == brute_lines(texts, tau, 20)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_dedup_of_null_ids_and_repeats(spark):
    a, b = "a line that is long enough to be compared 1", "a line that is long enough to be compared 2"
    got = line_dedup.dedup_lines(frame(spark, [(1, a), (1, a), (2, f"{b}\nx y"), (None, f"{a}\nx y\nown"), (3, "w" * 200_000), (4, "w" * 199_999)])).collect()
    assert sorted((repr(r.doc_id), r.text[:50]) for r in got) == [("1", a), ("1", a), ("2", "x y"), ("3", "w" * 50), ("4", ""), ("None", "own")]


def test_mixing(spark):
    rnd = random.Random(3)
    data = [(i, words(rnd, rnd.randrange(1, 80)), "en", rnd.choice(["a", "b", "b", "b", "c", "d", None]), 0, "x", 0.0) for i in range(700)] + [(1000, None, "en", "a", 0, "", 0.0), (1001, "", "en", "z", 0, "", 0.0)]
    docs = spark.createDataFrame(data, SCHEMA)
    out = mixing.mix(docs).collect()
    assert len(out) == len(data)
    size, taken, target = Counter(), Counter(), {}
    for r in out:
        size[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, open_, goal, left = {s: i % 3 + 1 for i, s in enumerate(order)}, set(order), {}, sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        goal |= {s: 3 * size[s] for s in over}
        if not over:
            goal |= share
            break
        left -= sum(3 * size[s] for s in over)
        open_ -= over
    for s in order:
        assert math.isclose(target[s], goal[s], abs_tol=1e-6) and abs(taken[s] - goal[s]) <= 40
    small = {s: min(r.size for r in out if r.source == s and r.size) for s in order if size[s]}
    assert all(abs(taken[s] - goal[s]) <= max(small[s], 0.01 * goal[s]) for s in small)
    again = mixing.mix(docs.repartition(7)).collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in out}
    repeated = Counter(r.doc_id for r in mixing.repeat(docs, mixing.mix(docs)).collect())
    assert repeated == Counter({r.doc_id: r.copies for r in out if r.copies})
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_meets_targets_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs).groupBy("source").agg(F.max("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("copies").alias("most")).collect()
    assert len(got) == 20 and all(abs(r.taken - r.target) <= 0.01 * r.target and r.most <= 3 for r in got)
    twice = docs.limit(50).unionByName(docs.limit(50)).withColumns({c: F.lit(2) for c in ("k", "nth", "copies", "_k", "_one")})
    mixed = mixing.mix(twice)
    out = mixing.repeat(twice, mixed)
    assert out.columns == twice.columns and out.count() == mixed.agg(F.sum("copies")).first()[0]


@pytest.mark.parametrize("rows", [8192, 100])
def test_top_k(spark, monkeypatch, rows):
    monkeypatch.setattr(topk, "BLOCK_ROWS", rows)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", rows // 8)
    rnd = np.random.default_rng(1)
    v = rnd.normal(0, 60, (900, 16)).round().astype(int)
    v[10:14] = v[9]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<long>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.exact_top_k(df, df.filter("vec_id % 9 = 0"), 5).collect()}
    for q in range(0, 900, 9):
        s = v @ v[q]
        best = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, s[i]) for i in best]
    odd = spark.createDataFrame([(1, [0.5, None]), (2, None), (3, [float("nan"), 1.0]), (4, [0.5, -0.1]), (5, [])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.v) for r in topk.quantized(odd).collect()] == [(4, [128, -26])]
    assert topk.exact_top_k(df.limit(0), df.limit(0)).count() == 0


def best_products(vectors, queries, k):
    """Brute force: (query id, rank) to (id, score), pairs of one length only."""
    out = {}
    for qid, q in queries:
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in vectors if i != qid and len(v) == len(q))
        out.update({(qid, r + 1): (i, -s) for r, (s, i) in enumerate(scores[:k])})
    return out


@pytest.mark.parametrize("lengths", [16, 1])
def test_top_k_of_clusters_lengths_and_repeats(spark, monkeypatch, lengths):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(topk, "LENGTHS", lengths)
    rnd = np.random.default_rng(2)
    centres = rnd.normal(0, 200, (6, 12)).round()
    rows = [(i, (centres[i % 6] + rnd.normal(0, 3, 12)).round().astype(int).tolist()) for i in range(400)]
    rows += [(500 + i, rnd.normal(0, 9, 5).round().astype(int).tolist()) for i in range(60)] + [(600, [0] * 12), (601, [7]), (602, [3]), (603, [1, 2])]
    rows += [(7, rows[7][1])] * 3 + [(8, rows[9][1])] * 100
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(5)
    queries = [r for r in rows[:464] if r[0] % 11 == 0 or r[0] >= 600]
    got = topk.exact_top_k(df, spark.createDataFrame(queries + queries[:3], "vec_id long, v array<long>"), 4).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == best_products(rows, queries, 4)
    assert len(got) == len({(r.query_id, r["rank"]) for r in got})


def test_pivots_exclude_candidates():
    rnd = np.random.default_rng(3)
    centres = rnd.normal(0, 100, (20, 16)).round()
    x = (centres[np.arange(4000) % 20] + rnd.normal(0, 2, (4000, 16))).round()
    pivots = np.vstack([centres, np.zeros(16)])
    far = np.sqrt(((x[:, None] - pivots) ** 2).sum(2)).astype(np.float32)
    found, evaluated = topk.search_block(np.arange(100), x[:100], far[:100], np.full(100, -np.inf), np.arange(4000), x, far, 5)
    assert 0 < evaluated < 0.2 * 100 * 4000 and len(found) == 100
    for i, scores, ids in found:
        s = x @ x[i]
        best = [j for j in np.lexsort((np.arange(4000), -s)) if j != i][:5]
        assert list(ids) == best and list(scores) == list(s[best])


def test_url_rules(spark):
    given = ["http://www.Example.com/en/1?a", "https://x.example.com/en/2", "http://a.net/es/3", "http://a.com/", "http://a.com", "no scheme", None, "http://example.net/fr#x", "http://b.org/x"]
    rows = {r.url: r for r in urls.judge(spark.createDataFrame([(u, 1) for u in given], "url string, host int")).collect()}
    assert [(rows[u].rule, rows[u].verdict) for u in given[:4]] == [("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("net/es/", "block"), ("com/", "allow")]
    assert rows[given[4]].rule is None and rows["no scheme"].host == "" and rows[None].path == "" and rows[given[7]].rule is None
    many = [f"http://{'bad' if i % 2 else 'good'}-{i}.{'example.com/en' if i % 2 else 'a.com'}/{i}" for i in range(200)] + ["http://bad-1.c.org/7", "http://good-2.c.org/7"]
    out = {r.url: r.verdict for r in urls.judge(spark.createDataFrame([(u,) for u in many], "url string")).collect()}
    assert (out[many[-2]], out[many[-1]]) == ("block", "allow")
    assert urls.judge(spark.createDataFrame([], "url string")).count() == 0


def test_url_columns_stay(spark):
    pages = spark.createDataFrame([("http://a.net/es/1", *"abcdefgh")], "url string, mined string, url_key string, _fixed string, _tokens string, _key string, host string, path string, verdict string")
    out = urls.judge(pages)
    assert sorted(out.columns) == sorted([*pages.columns, "rule"])
    r = out.first()
    assert (r.mined, r.url_key, r._fixed, r._key, r.host, r.rule, r.verdict) == ("a", "b", "c", "e", "a.net", "net/es/", "block")


def test_mined_url_rules_equal_brute_force(spark):
    """All token combinations of enough support and confidence, and the surest that fits."""
    rnd, rows = random.Random(12), []
    for _ in range(300):
        held = sorted({rnd.choice("abcdef") for _ in range(rnd.randrange(0, 5))})
        block = "a" in held and "b" in held or rnd.random() < 0.1
        rows.append((held, "block" if block else "allow"))
    rules = {(tuple(r.parts), r.verdict): (r.confidence, r.support) for r in urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.02, 0.9, 5).collect()}
    want = {}
    for n in range(1, 7):
        for parts in itertools.combinations("abcdef", n):
            fits = Counter(v for held, v in rows if set(parts) <= set(held))
            for verdict, k in fits.items():
                if k >= 0.02 * len(rows) and k >= 0.9 * sum(fits.values()):
                    want[parts, verdict] = (k / sum(fits.values()), k / len(rows))
    assert rules.keys() == want.keys() and want and all(rules[k] == pytest.approx(want[k]) for k in want)
    df = spark.createDataFrame([(p, v, c, s) for (p, v), (c, s) in want.items()], "parts array<string>, verdict string, confidence double, support double").withColumn("rule_id", F.monotonically_increasing_id())
    some = [list(x) for n in range(5) for x in itertools.combinations("abcdef", n)]
    got = {r.url_key: r.mined for r in urls.match_rules(spark.createDataFrame(list(enumerate(some)), "url_key long, tokens array<string>"), df).collect()}
    for i, held in enumerate(some):
        fit = {v for (p, v), x in want.items() if set(p) <= set(held) and (*x, len(p)) == max((*want[q, w], len(q)) for q, w in want if set(q) <= set(held))}
        assert got.get(i) in fit if fit else i not in got


def test_quality_rules(spark):
    rnd = random.Random(8)
    shared = "a line that very many documents of one host hold in common with others"
    texts = [(i, f"{shared}\n{words(rnd, 30, 100000)}") for i in range(130)] + [(200, f"{shared}\nz1 z2 z3 z4 z5 z6 z7 z8 z9"), (300, None), (301, ""), (302, "a b c d e f g h " * 12 + "# % |")]
    out = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark, texts, "h"), max_docs=100, min_left=0.5).collect()}
    for i, t in texts:
        w = WORD.findall(t or "")
        c = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        covered = {k for j in range(len(w) - 7) if c[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (out[i].n_words, out[i].n_repeat_words, out[i].n_dup_lines) == (len(w), len(covered), len(lines) - len(set(lines)))
        assert out[i].n_symbols == sum(x in "#*$%&|<>" for x in t or "") and out[i].word_chars == sum(map(len, w))
    assert all(out[i].kept for i in range(130)) and not out[200].kept and not out[200].base_failed and out[302].base_failed and not out[300].kept
    assert quality_rules.quality_rules(frame(spark, [])).count() == 0


def test_quality_rules_follow_the_size_of_the_host(spark):
    rnd = random.Random(9)
    line = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(8)) for _ in range(n))
    rows, kept = [], {}

    def host(name, n, shares):
        """``n`` documents; the first ones hold little besides a line of 25 words that so many share."""
        texts = [line(30) for _ in range(n)]
        at = 0
        for held, goes in shares:
            common = line(25)
            for i in range(at, at + held):
                texts[i] = f"{common}\n{line(2 if i % 2 else 40)}"
                kept[len(rows) + i] = not (goes and i % 2)
            at += held
        for t in texts:
            kept.setdefault(len(rows), True)
            rows.append((len(rows), t, "en", name, 0, "x", 0.0))

    host("tiny", 5, [(5, False)])
    host("small", 30, [(6, True), (5, False)])
    host("large", 400, [(9, True), (8, False), (40, True)])
    host(None, 40, [(20, True)])
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(r.base_failed for r in out.values())
    assert {i: r.kept for i, r in out.items()} == kept


def test_quality_rules_count_a_repeated_document_once(spark):
    rnd = random.Random(10)
    line = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(8)) for _ in range(n))
    common = line(25)
    rows = [(1, f"{common}\n{line(10)}")] * 150 + [(i, line(30)) for i in range(2, 40)] + [(None, line(30))] * 3
    rows += [(i, f"{common}\n{line(2)}") for i in range(40, 43)] * 3  # four documents hold the line
    got = quality_rules.quality_rules(frame(spark, rows, None)).collect()
    assert len(got) == len(rows) and all(r.kept for r in got)
    rows += [(i, f"{common}\n{line(2)}") for i in range(43, 46)]  # now seven
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(frame(spark, rows, "h")).collect()}
    assert {i for i, k in kept.items() if not k} == set(range(40, 46))


def test_language(spark):
    rnd = random.Random(4)
    make = lambda parts: " ".join("".join(rnd.choice(parts) for _ in range(3)) for _ in range(40))
    kinds = {"xx": ["tha", "ion", "ing"], "yy": ["sch", "ung", "ßen"], "zz": ["ció", "dad", "ñor"]}
    rows = [(i, make(kinds[k]), k) for i, k in enumerate(rnd.choice(list(kinds)) for _ in range(200))]
    model = language.fit(spark.createDataFrame([*rows, (500, None, "xx"), (501, "abc", None)], "doc_id long, text string, lang string"))
    test = [(i, make(kinds[k]).upper(), k) for i, k in enumerate(kinds)] + [(10, None, "und"), (11, "12 !", "und")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(spark.createDataFrame(test, "doc_id long, text string, lang string"), model).collect()}
    assert all(got[i][0] == k and 0 <= got[i][1] <= 1 for i, _, k in test)
    empty = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert empty.predict("text") == ("und", 0.0)


def test_quality_classifier(spark):
    rnd = random.Random(6)
    text = lambda good: words(rnd, 60) if good else " ".join(x.upper() + "!!" for x in words(rnd, 60).split())
    data = [(i, text(i % 4 > 0), int(i % 4 > 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data if i < 300], "doc_id long, label int")
    model = quality_model.fit(docs, labels)
    got = {r.doc_id: r for r in quality_model.classify(docs, model).collect()}
    assert all(got[i].predicted == y for i, _, y in data) and all(0 <= r.score <= 1 for r in got.values()) and model.rules and str(model)
    assert quality_model.fit(docs, labels.limit(0)).rules == []


def test_statistics_equal_brute_force(spark):
    rnd = random.Random(7)
    some = ["a", "Word", "UPPER!!", "x", "x", "12", "#", "é.", " ", "\n", "\n\n", "\t", "long" * 500]
    texts = [None, "", " \n", *("".join(rnd.choice(some) + rnd.choice([" ", ""]) for _ in range(rnd.randrange(30))) for _ in range(150)), "w " * 50_000]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", quality_model.statistics(F.col("t")).alias("s")).collect()
    for r in got:
        t = texts[r.i] or ""
        w, lines, count = WORD.findall(t), [x for x in t.split("\n") if x], lambda letters: sum(c in letters for c in t)  # noqa: B023
        chars, n = max(sum(map(len, w)), 1), max(len(w), 1)
        want = [math.log1p(len(w)), chars / n, count("#*$%&|<>") / chars, count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, count("!") / n, count(".,;:") / n, count("0123456789") / chars,
                sum(len(x) <= 3 for x in w) / n, len(set(w)) / n, sum(a == b for a, b in itertools.pairwise(w)) / n, 1 - len(set(lines)) / max(len(lines), 1)]
        assert list(r.s) == pytest.approx(want), t[:80]


def test_compiled_rules_equal_plain_ones(spark):
    rules = [(((0, True, 1.5), (3, False, 0.2)), 0.7), (((2, True, 0.0),), -1.25), ((), 0.1)]
    model, rnd = quality_model.RuleModel(rules, -0.3), random.Random(8)
    rows = [[rnd.choice([0.0, 0.2, 1.5, rnd.random() * 3]) for _ in quality_model.FEATURES] for _ in range(100)]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x array<double>").select("i", model.score(F.col("x")).alias("s")).collect()
    for r in got:
        total = -0.3 + sum(w for rule, w in rules if all(rows[r.i][f] > x if above else rows[r.i][f] <= x for f, above, x in rule))
        assert r.s == pytest.approx(1 / (1 + math.exp(-total)))
    odd = frame(spark, [(1, "a"), (1, "a"), (None, None)]).withColumn("predicted", F.lit("x"))
    assert quality_model.classify(odd, model).count() == 3 and quality_model.fit(odd, spark.createDataFrame([(1, 0), (1, 1)], "doc_id long, label int")).rules == []


def test_language_equals_brute_force(spark):
    """The filter has no false negatives, and its corrected counts name the language that plain sets name."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in docs.collect() if r.text]
    model = language.fit(docs.filter("doc_id % 2 = 0"))
    held, sizes = defaultdict(Counter), Counter(r.lang for r in rows if r.doc_id % 2 == 0 and r.lang)
    for r in rows:
        if r.doc_id % 2 == 0 and r.lang:
            held[r.lang].update(set(language.grams(r.text).tolist()))
    sets = {k: {g for g, n in c.items() if n >= max(2.0 if sizes[k] > 20 else 1.0, 0.01 * sizes[k])} for k, c in held.items()}
    for i, k in enumerate(model.languages):
        a, b, c = language.slots(np.array(sorted(sets[k]), np.uint32))
        assert ((model.masks[0][a] & model.masks[0][b] & model.masks[0][c]) >> np.uint64(i) & np.uint64(1)).all()
    got, same, clear = {r.doc_id: r for r in language.identify(docs.withColumn("score", F.lit("x")), model).collect()}, 0, 0
    for r in rows:
        g = language.grams(r.text).tolist()
        n = sorted(((sum(x in sets[k] for x in g), k) for k in sets), reverse=True)
        if any(map(str.isalpha, r.text)) and n[0][0] > n[1][0] + 0.02 * len(g):
            clear, same = clear + 1, same + (got[r.doc_id].lang_pred == n[0][1])
    assert clear > 100 and same == clear
    long_ = spark.createDataFrame([(1, "the " * 100_000, None), (1, "", None), (None, "the", None)], "doc_id long, text string, lang string")
    assert language.identify(long_, model).count() == 3


def test_packing_replaces_columns_and_certifies(spark):
    rnd = np.random.default_rng(4)
    sizes = [0, 4096, *rnd.integers(1, 4097, 5000).tolist()]
    pieces = spark.createDataFrame([(i, s, "x", "y", "z") for i, s in enumerate(sizes)], "piece int, length long, offset string, sequence_id string, row_id string")
    packed = packing.pack(pieces)
    assert sorted(packed.columns) == sorted(pieces.columns) and {r.row_id for r in packed.collect()} == {"z"}
    found = packing.certificate(packed).first()
    assert found.bound == packing.lower_bound(np.array(sizes)) and found.bound <= found.sequences <= 1.01 * found.bound + 2
