"""Repeats, ties, extra columns, several blocks and empty tables of the older operators and of the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from kinweave.functions.staging import Staging
from kinweave.llm import huffman, language, packing, quality_model


def test_huffman_of_several_blocks_repeats_and_clashes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 50)
    rnd = random.Random(1)
    texts = [(i // 3, " ".join(rnd.choice(["alpha", "beta", "x", "12"]) for _ in range(rnd.randrange(40)))) for i in range(60)] + [(None, "null"), (None, None), (7, "word " * 3000)]
    docs = spark.createDataFrame([(i, t, "a", "b", 3, 4) for i, t in texts], "doc_id long, text string, ids string, lengths string, n_tokens int, start int").repartition(3)
    name, path = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "ids")
    huffman.write_blocks(docs, name, path, end_id=2)
    t = Tokenizer.from_file(name)
    got = huffman.digest(spark, path).collect()
    ids = lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]
    want = Counter((i, len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for i, x in texts for v in [ids(x)])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known)


def test_packing_of_ties_and_repeats(spark):
    pieces = spark.createDataFrame([(1, 0, 2048)] * 9 + [(2, 0, 4096)] * 2 + [(3, 0, 1), (4, 0, 0), (None, 0, 5)], "doc_id long, piece int, length long")
    rows = packing.pack(pieces).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    assert len(rows) == 14 and len(by) == 7
    assert all(sum(n for _, n in v) <= 4096 and [a for a, _ in sorted(v)] == np.cumsum([0, *[n for _, n in sorted(v)]])[:-1].tolist() for v in by.values())
    name = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(5, "same text")] * 3, "doc_id long, text string")
    assert packing.pieces_of(docs, name).count() == 3 and packing.pieces_of(docs.limit(0), name).count() == 0


def test_classifiers_of_ties_repeats_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = quality_model.fit(none, spark.createDataFrame([], "doc_id long, label int"))
    assert quality_model.classify(none, model).count() == 0
    same = spark.createDataFrame([(i % 5, "just one text") for i in range(40)], "doc_id long, text string")
    tied = quality_model.fit(same, spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, label int"))
    assert len({r.score for r in quality_model.classify(same, tied).collect()}) == 1
    languages = spark.createDataFrame([(i, "ein text", lang) for i, lang in enumerate(["b", "a"] * 20)], "doc_id long, text string, lang string")
    first = language.fit(languages)
    again = language.fit(languages.orderBy("lang", "text"))
    got = {(r.lang_pred, r.score) for m in (first, again) for r in language.identify(languages.select("doc_id", "text"), m).collect()}
    assert len(got) == 1 and next(iter(got))[0] in "ab"
    assert language.identify(none, first).count() == 0


def test_pipeline_of_odd_documents_and_of_none(spark, tmp_path):
    rnd = random.Random(2)
    good = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    long = " ".join(f"w{rnd.randrange(9999)}" for _ in range(40_000))
    odd = [(None, "text of a null id", "en", "s", 1), (9001, None, None, None, None), (9002, "", "en", None, 0), (9003, long, "en", "s", len(long)), (9003, long, "en", "s", len(long)), (9004, " \n", "en", "", 2)]
    docs = good.limit(40).unionByName(spark.createDataFrame(odd, good.schema))
    for name, df in (("odd", docs), ("none", good.limit(0))):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    stage, at, seen = Staging(spark, "odd"), str(tmp_path / "odd"), {}
    rows = spark.read.parquet(f"{at}/documents.parquet")
    for name, f in corpus_pipeline.STAGES:
        rows = seen[name] = stage.write(f(spark, rows, at), name)
    # Repeated rows are one document, whose rows stay or go together.
    assert seen["minhash_near_dedup"].filter("doc_id = 9003").count() in (0, 2)
    assert seen["best_fit_packing"].count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
