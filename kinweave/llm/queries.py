"""Registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm import centroids, huffman, importance, language, line_dedup, minhash, mixing, packing, quality_model, quality_rules, ring, topk, urls
from kinweave.llm.common import remainder, table


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that a model may learn from."""
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id")) != 1)
    return labels.select("doc_id", F.col("quality").alias("label"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; a null or empty text is scored like any other. Learns from labels that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_model.classify(docs, quality_model.fit(docs, quality_labels(spark, sf_dir)))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")


def op2_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document; a null text has size 0 and is taken 0 times."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of 2-word shingles; documents without words are linked with nothing."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stay of each document, with one edit; a null text stays null, with null counts as in the SQL."""
    left = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_kept", F.length("text").cast("long").alias("n_chars_kept"), F.md5("text").alias("text_md5"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents; ``und`` for null texts and those without a letter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(remainder(F.col("doc_id")) != 1))
    return language.identify(docs, model).select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score")


def op6_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every 50th vector; vectors that are null or hold null or non-finite components take no part, components beyond 2**62 are an error."""
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op7_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as Huffman blocks and read back; a null text has only the end id."""
    path = Staging(spark, "ids").root
    huffman.write_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=2)
    return huffman.digest(spark, path)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each token piece in a sequence of 4096; a null text is a piece of the end id."""
    pieces = packing.pieces_of(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all urls; null urls have an empty host and path and take the default."""
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def url_fixed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed half of op9: host, path, rule and its verdict, null where none fits."""
    pages = urls.parsed(table(spark, sf_dir, "pages").select("page_id", "url")).withColumn("fixed", urls.fitting_rule())
    return pages.select("page_id", "host", "path", "fixed.rule", "fixed.verdict")


def op10_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdicts of all documents; null and empty texts fail the base rules."""
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_prefix_crc_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws a quarter of the documents toward the n-grams of ``benchmark``; undrawn documents have a null rank."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.resample(docs, table(spark, sf_dir, "benchmark"), percent=25, least_words=20, most=2, buckets=10_000, seed=7)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_ns_bounds_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 clusters of all vectors of 64 components after three updates of the centroids."""
    return centroids.clustered(centroids.quantized(table(spark, sf_dir, "embeddings"), size=64, scale=64), k=16, rounds=3, seed=1)


def op13_bounded_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of equal numbers of documents; equal texts share a place on the ring."""
    text = F.coalesce("text", F.lit(""))
    sized = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = ring.shard(sized, 40, key="text_crc32", hashed=True)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_pivotal_mixing": op2_pivotal_mixing,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_pivot_top_k": op6_pivot_top_k,
    "op7_huffman_ids": op7_huffman_ids,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_url_rules": op9_url_rules,
    "url_fixed_rules": url_fixed_rules,
    "op10_line_frequency_rules": op10_line_frequency_rules,
    "op11_prefix_crc_resampling": op11_prefix_crc_resampling,
    "op12_ns_bounds_kmeans": op12_ns_bounds_kmeans,
    "op13_bounded_ring_shards": op13_bounded_ring_shards,
}

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x != '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 of hex digits: the table of a byte, and a fold over the bytes.
_CRC_TABLE = "crcs AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"
_CRC = "xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(len({0}) // 2), lambda i: CAST('0x' || substr({0}, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"
_RUNS = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"


def _kmeans_sql(rounds: int = 3, k: int = 16) -> str:
    """All distances in every round, without bounds."""
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INTEGER) AS cluster, e AS c FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v ORDER BY h, e LIMIT {k}))"""]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (
  SELECT i, min(struct_pack(d := d, cluster := cluster)) AS x
  FROM (SELECT i, cluster, CAST(list_sum(list_transform(range(1, 65), lambda j: (e[j] - c[j]) * (e[j] - c[j]))) AS BIGINT) AS d FROM v, c{t}) GROUP BY i)""")
        if t < rounds:
            parts.append(f"""m{t} AS MATERIALIZED (
  SELECT cluster, list(m ORDER BY j) AS c FROM (
    SELECT x.cluster AS cluster, j, CAST(floor(CAST(sum(e[j]) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM a{t} JOIN v USING (i), (SELECT unnest(range(1, 65)) AS j) GROUP BY 1, 2) GROUP BY cluster),
c{t + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{t} c LEFT JOIN m{t} m USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, x.cluster AS cluster, x.d AS distance, CAST(sum(x.d) OVER (PARTITION BY x.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(x.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN v USING (i) JOIN c{rounds} q ON q.cluster = x.cluster
"""


ORACLES: dict[str, str] = {
    "op3_minhash_near_dedup": f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
held AS (SELECT doc_id, n, unnest(s) AS v FROM sized),
freq AS (SELECT v, count(*) AS f FROM held GROUP BY v),
ranked AS (SELECT doc_id, n, h.v, f, row_number() OVER (PARTITION BY doc_id ORDER BY f, h.v) AS r FROM held h JOIN freq USING (v)),
rare AS (SELECT doc_id, n, v FROM ranked WHERE f > 1 AND r <= n - ceil(n * 0.8) + 1),
pairs AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM rare x JOIN rare y USING (v) WHERE x.doc_id < y.doc_id AND 10 * least(x.n, y.n) >= 8 * greatest(x.n, y.n)),
links AS (
  SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))),
links2 AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, b FROM reach r JOIN links2 ON a = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM sized s JOIN comp USING (doc_id)
""",
    "op4_line_dedup": r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
firsts AS (SELECT line, min(doc_id) AS doc_id FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line),
met AS (
  SELECT x.line AS a, y.line AS b FROM firsts x JOIN firsts y ON left(x.line, 16) = left(y.line, 16) WHERE least(length(x.line), length(y.line)) >= 32 AND abs(length(x.line) - length(y.line)) <= 1 AND x.doc_id < y.doc_id
  UNION
  SELECT x.line, y.line FROM firsts x JOIN firsts y ON right(x.line, 15) = right(y.line, 15) WHERE least(length(x.line), length(y.line)) >= 32 AND abs(length(x.line) - length(y.line)) <= 1 AND x.doc_id < y.doc_id),
lost AS (SELECT DISTINCT b AS line FROM met WHERE levenshtein(a, b) <= 1),
judged AS (
  SELECT l.doc_id, l.pos, l.line, f.line IS NULL OR (l.line NOT IN (SELECT line FROM lost) AND l.doc_id = f.doc_id
    AND row_number() OVER (PARTITION BY l.doc_id, l.line ORDER BY l.pos) = 1) AS stays
  FROM lines l LEFT JOIN firsts f ON f.line = l.line),
joined AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (stays) AS n_kept, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '') AS kept FROM judged GROUP BY doc_id)
SELECT doc_id, n_lines, n_kept, length(kept) AS n_chars_kept, md5(kept) AS text_md5 FROM joined
""",
    "op6_pivot_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 5
""",
    "url_fixed_rules": r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
split AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
lowered AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split),
fits AS (
  SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM lowered l JOIN rules r ON (l.host = r.host OR ends_with(l.host, '.' || r.host)) AND starts_with(l.path, r.path) GROUP BY page_id)
SELECT page_id, host, path, rule, verdict FROM lowered LEFT JOIN fits USING (page_id)
""",
    "op10_line_frequency_rules": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x != '') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS v FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) t(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
worded AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
normal AS (SELECT DISTINCT doc_id, source, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM lines JOIN documents USING (doc_id)),
held AS (SELECT source, line, count(*) AS n FROM normal WHERE line <> '' GROUP BY source, line),
hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
often AS (SELECT h.source, h.line FROM held h JOIN hosts s ON h.source IS NOT DISTINCT FROM s.source WHERE n > 5 AND n > 0.02 * docs),
gone AS (
  SELECT doc_id FROM (SELECT n.doc_id, sum(length(n.line)) AS every, coalesce(sum(CASE WHEN o.line IS NOT NULL THEN length(n.line) END), 0) AS cut
    FROM normal n LEFT JOIN often o ON o.line = n.line AND o.source IS NOT DISTINCT FROM n.source WHERE n.line <> '' GROUP BY n.doc_id)
  WHERE cut > 0 AND every - cut < 0.25 * every),
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM d LEFT JOIN worded l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM gone) AS kept FROM failed
""",
    "op11_prefix_crc_resampling": rf"""
WITH {_CRC_TABLE},
words AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w FROM documents),
aims AS (SELECT list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w FROM benchmark),
own AS (SELECT doc_id, unnest({_RUNS}) AS f FROM words),
aimed AS (SELECT unnest({_RUNS}) AS f FROM aims),
hashed AS (SELECT f, {_CRC.format("hex(encode(f))")} % 10000 AS bucket FROM (SELECT f FROM own UNION SELECT f FROM aimed), crcs),
s AS (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM aimed JOIN hashed USING (f) GROUP BY bucket),
totals AS (SELECT CAST((SELECT count(*) FROM own) AS DOUBLE) AS n_s, CAST((SELECT count(*) FROM aimed) AS DOUBLE) AS n_t),
gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (n_s + 10000) / (CAST(s + 1 AS DOUBLE) * (n_t + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), totals),
means AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM own JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS fine,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN means USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE fine)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= (SELECT count(*) FROM scored WHERE fine) * 25 // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
""",
    "op12_ns_bounds_kmeans": _kmeans_sql(),
    # Home rows by running sums; what is left goes on clockwise, a step for each arc and shard that fills up.
    "op13_bounded_ring_shards": rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, octet_length(encode(x)) + 16 AS size, {_CRC.format("hex(encode(x))")} AS crc FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents), crcs),
nodes AS (SELECT shard, {_CRC.format("h")} >> 16 AS point FROM (SELECT s.range AS shard, hex(encode(s.range || ':' || i.range)) AS h FROM range(40) s, range(64) i), crcs),
ring AS MATERIALIZED (SELECT row_number() OVER (ORDER BY point, shard) - 1 AS pos, point, shard FROM nodes),
ends AS (SELECT point, min(pos) AS pos FROM ring GROUP BY point),
placed AS MATERIALIZED (SELECT doc_id, size, crc, coalesce(pos, 2560) AS arc FROM d ASOF LEFT JOIN ends ON (d.crc >> 16) <= ends.point),
numbered AS (SELECT *, row_number() OVER (PARTITION BY arc ORDER BY crc, doc_id) - 1 AS place FROM placed),
bounds AS (SELECT s.range AS shard, n // 40 + CASE WHEN s.range < n % 40 THEN 1 ELSE 0 END AS bound FROM range(40) s, (SELECT count(*) AS n FROM documents)),
loads AS (SELECT arc, shard, count(*) AS n FROM placed JOIN ring ON pos = arc % 2560 GROUP BY arc, shard),
before AS (SELECT l.arc, l.shard, n, bound, coalesce(sum(n) OVER (PARTITION BY l.shard ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM loads l JOIN bounds USING (shard)),
home AS MATERIALIZED (SELECT arc, shard, n, greatest(0, least(n, bound - b)) AS t, least(b, bound) AS slot FROM before),
rest AS MATERIALIZED (
  SELECT list(arc ORDER BY arc) AS arcs, list(n - t ORDER BY arc) AS lefts, list(t ORDER BY arc) AS firsts FROM home WHERE n > t),
rooms AS (SELECT list(bound - coalesce(t, 0) ORDER BY shard) AS rooms, list(bound ORDER BY shard) AS full_ FROM bounds LEFT JOIN (SELECT shard, sum(t) AS t FROM home GROUP BY shard) USING (shard)),
steps AS (
  SELECT 0 AS step, 1 AS i, CAST(lefts[1] AS BIGINT) AS left_, list_transform(rooms, lambda x: CAST(x AS BIGINT)) AS rooms, CAST(NULL AS BIGINT) AS arc, CAST(NULL AS BIGINT) AS shard, CAST(NULL AS BIGINT) AS t, CAST(NULL AS BIGINT) AS f, CAST(NULL AS BIGINT) AS slot
  FROM rest, rooms WHERE arcs IS NOT NULL
  UNION ALL
  SELECT step + 1, CASE WHEN left_ > take THEN i ELSE i + 1 END, CAST(CASE WHEN left_ > take THEN left_ - take ELSE lefts[i + 1] END AS BIGINT),
    list_transform(was, lambda x, j: CASE WHEN j = s + 1 THEN x - take ELSE x END), CAST(arcs[i] AS BIGINT), s, take, CAST(firsts[i] + lefts[i] - left_ AS BIGINT), CAST(full_[s + 1] - was[s + 1] AS BIGINT)
  FROM (SELECT *, least(left_, was[s + 1]) AS take FROM (
    SELECT step, i, left_, st.rooms AS was, rest.*, r.full_, CAST(ss[list_filter(range(arcs[i], arcs[i] + 2560), lambda p: st.rooms[ss[p % 2560 + 1] + 1] > 0)[1] % 2560 + 1] AS BIGINT) AS s
    FROM steps st, rest, rooms r, (SELECT list(shard ORDER BY pos) AS ss FROM ring) WHERE left_ IS NOT NULL))),
ways AS (SELECT arc, 0 AS f, t, shard, slot FROM home WHERE t > 0 UNION ALL SELECT arc, f, t, shard, slot FROM steps WHERE t > 0)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(slot + place - f AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered n JOIN ways w ON w.arc = n.arc AND place >= f AND place < f + t
""",
}
