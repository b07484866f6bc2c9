"""The stages of the pipeline on the smallest tables, each against a plain version."""

from collections import Counter, defaultdict

from test_llm import brute_components, brute_lines

import corpus_pipeline
from kinweave.functions.staging import Staging

DIR = "/root/testdata/sf0.001"


def test_pipeline(spark):
    stage, docs, seen = Staging(spark, "test"), spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        out = stage.write(f(spark, docs, DIR), name)
        seen.append((docs, out))
        docs = out
    assert all(out.columns == corpus_pipeline.COLUMNS for _, out in seen[:-1])
    texts = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    kept = {i for i, _ in texts(seen[0][1])}
    right = sum((i in kept) == bool(q) for i, q in labels.items())
    assert right >= 0.95 * len(labels)

    given, left = texts(seen[1][0]), dict(texts(seen[1][1]))
    assert left == {i: t for i, t in brute_lines(given, 1, 32).items() if t.split() or t == dict(given)[i]}

    given, left = texts(seen[2][0]), {i for i, _ in texts(seen[2][1])}
    assert left == {i for i, (_, c) in brute_components(given, 5, 80).items() if i == c}

    given, copies = dict(texts(seen[3][0])), Counter(i for i, _ in texts(seen[3][1]))
    assert set(copies) <= set(given) and max(copies.values()) <= 3

    by, n = defaultdict(list), Counter()
    for r in seen[4][1].collect():
        by[r.sequence_id].append((r.offset, r.length))
        n[r.doc_id] += r.piece == 0
        assert len(r.ids) == 4 * r.length
    assert n == copies
    for v in by.values():
        v.sort()
        assert all(a + k == b for (a, k), (b, _) in zip(v, v[1:], strict=False)) and v[0][0] == 0 and sum(k for _, k in v) <= 4096
