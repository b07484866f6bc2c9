"""Roles that the driver's tables play for the operators, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One definition serves Spark SQL and the oracle; names of earlier views may be used.
VIEWS = {
    "hits": "SELECT concat('N', l_partkey) AS qseqid, concat('N', l_suppkey) AS sseqid, 100 - l_discount * 100 AS pident, CAST(l_quantity AS INT) AS alignment_length, l_extendedprice / 100 AS bitscore FROM lineitem",
    "lengths": "SELECT concat('N', p_partkey) AS seqid, CAST(p_size * 10 AS BIGINT) AS sequence_length FROM part",
    "pairs": "SELECT least(upper(qseqid), upper(sseqid)) AS qseqid, greatest(upper(qseqid), upper(sseqid)) AS sseqid, pident, alignment_length, bitscore FROM hits WHERE qseqid <> sseqid",
    "best": "SELECT qseqid, sseqid, pident, alignment_length, bitscore FROM (SELECT *, row_number() OVER (PARTITION BY qseqid, sseqid ORDER BY bitscore DESC, pident, alignment_length) AS rn FROM pairs) x WHERE rn = 1",
    "edges": "SELECT b.qseqid, b.sseqid, b.pident, b.alignment_length, b.bitscore, q.sequence_length AS query_length, s.sequence_length AS subject_length, CAST(floor(-log10(CAST(q.sequence_length AS DOUBLE) * CAST(s.sequence_length AS DOUBLE)) + log10(2) * b.bitscore) AS INT) AS alignment_score FROM best b LEFT JOIN lengths q ON q.seqid = b.qseqid LEFT JOIN lengths s ON s.seqid = b.sseqid",
    "net": "SELECT * FROM edges",
    "netnodes": "SELECT DISTINCT concat('N', p_partkey) AS node FROM part",
    "shop": "SELECT concat('O', o_orderkey) AS qseqid, concat('C', o_custkey) AS sseqid FROM orders UNION ALL SELECT concat('D', doc_id) AS qseqid, concat('D', min(doc_id) OVER (PARTITION BY md5(text))) AS sseqid FROM documents",
    "shopnodes": "SELECT concat('O', o_orderkey) AS node FROM orders UNION ALL SELECT concat('C', c_custkey) AS node FROM customer UNION ALL SELECT concat('D', doc_id) AS node FROM documents",
    "taxonomy": "SELECT n_nationkey AS taxonomy_id, r_name AS domain, n_name AS kingdom, CASE WHEN n_nationkey % 5 = 0 THEN 'Ascomycota' ELSE concat('Phylum', n_nationkey % 3) END AS phylum, concat('Species', n_nationkey % 4) AS species FROM nation JOIN region ON r_regionkey = n_regionkey",
    "people": "SELECT concat('C', c_custkey) AS accession, c_nationkey AS taxonomy_id, c_mktsegment AS segment, c_acctbal > 5000 AS is_reviewed, c_acctbal < 0 AS is_fragment, c_custkey % 2 = 0 AS gdna, concat(c_name, '; ') AS description FROM customer",
    "seeds": "SELECT concat('C', c_custkey) AS accession, concat('C', min(c_custkey) OVER (PARTITION BY c_nationkey)) AS seed50, concat('C', min(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment)) AS seed90 FROM customer",
    "fams": "SELECT p_brand AS family, concat('C', p_partkey) AS accession, 1 + p_partkey % 50 AS start, 1 + p_partkey % 50 + p_size AS stop FROM part",
    "clans": "SELECT DISTINCT p_brand AS family, concat('CL', length(p_brand)) AS clan FROM part",
    "foreign_": "SELECT concat('C', o_custkey) AS uniprot_id, CASE WHEN o_orderkey % 2 = 0 THEN 'gi' ELSE 'pdb' END AS foreign_id_type, CAST(o_orderkey AS VARCHAR(20)) AS foreign_id FROM orders",
    "genes": "SELECT concat('G', user_id) AS genome, concat('E', event_id) AS accession, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS num, user_id % 2 = 1 AS linear, value > 50 AS normal, CAST(event_id * 10 AS INT) AS start, CAST(event_id * 10 + 100 + event_id % 900 AS INT) AS stop, event_type AS family FROM events",
    "asked": "SELECT concat('E', event_id) AS accession, CAST(floor(event_id / 37) AS INT) AS cluster_num FROM events",
    "colors": "SELECT CAST(p_partkey + 1 AS INT) AS num, concat('#', lpad(CAST(p_partkey * 37 % 999999 AS VARCHAR(9)), 6, '0')) AS color FROM part WHERE p_partkey < 12",
}

#: Views for oracles only. Labels spread over nine links, more than any path in the tables is long.
ORACLE_VIEWS = {
    "links": "SELECT qseqid AS a, sseqid AS b FROM net UNION SELECT sseqid, qseqid FROM net UNION SELECT qseqid, qseqid FROM net UNION SELECT sseqid, sseqid FROM net",
    "label0": "SELECT a AS node, min(b) AS label FROM links GROUP BY a",
    **{f"label{i}": f"SELECT b AS node, min(label) AS label FROM label{i - 1} JOIN links ON a = node GROUP BY b" for i in range(1, 9)},
    "netcomp": "SELECT node, label AS component FROM label8",
    "comps": "SELECT node, component FROM netcomp UNION ALL SELECT node, node FROM netnodes WHERE node NOT IN (SELECT node FROM netcomp)",
    "stars": "SELECT qseqid AS node, sseqid AS center FROM shop UNION SELECT sseqid, sseqid FROM shop UNION SELECT node, node FROM shopnodes WHERE node NOT IN (SELECT qseqid FROM shop) AND node NOT IN (SELECT sseqid FROM shop)",
    "starcomps": "SELECT node, min(node) OVER (PARTITION BY center) AS component FROM stars",
    "sizes": "SELECT component, count(*) AS num_nodes, CAST(sum(CAST(substr(node, 2) AS BIGINT) % 3 + 1) AS BIGINT) AS num_seqs FROM starcomps GROUP BY component",
    "numbered": "SELECT component, num_nodes, num_seqs, row_number() OVER (ORDER BY num_seqs DESC, component) AS cluster_num_by_seq, row_number() OVER (ORDER BY num_nodes DESC, component) AS cluster_num_by_node FROM sizes WHERE num_seqs > 1",
    "picked": "SELECT *, row_number() OVER (PARTITION BY accession ORDER BY linear, CASE WHEN NOT linear THEN -max_num END, CASE WHEN linear THEN num > 10 END DESC, CASE WHEN linear THEN num < max_num - 10 END DESC, CASE WHEN linear THEN abs(num / max_num - 0.5) END, genome, num) AS r FROM (SELECT g.*, max(num) OVER (PARTITION BY genome) AS max_num, last_value(stop) OVER (PARTITION BY genome ORDER BY num ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS max_stop FROM genes g) WHERE accession IN (SELECT accession FROM asked)",
    "chosen": "SELECT * EXCLUDE (r) FROM picked WHERE r = 1",
    "near": """SELECT c.accession AS query, c.genome, g.accession AS neighbor, g.num, c.num AS q_num, c.linear AS q_linear, c.max_num, c.max_stop, c.start AS q_start, c.normal AS q_normal, g.start, g.stop, g.normal, g.linear, g.family,
  NOT c.linear AND 20 < c.max_num AND c.num - 20 < 1 AND g.num > c.num + 20 AS before, NOT c.linear AND 20 < c.max_num AND c.num + 20 > c.max_num AND g.num < c.num - 20 AS after
  FROM chosen c JOIN genes g ON g.genome = c.genome AND ((g.num BETWEEN c.num - 20 AND c.num + 20)
    OR (NOT c.linear AND 20 < c.max_num AND c.num - 20 < 1 AND g.num >= c.max_num + c.num - 20)
    OR (NOT c.linear AND 20 < c.max_num AND c.num + 20 > c.max_num AND g.num <= c.num + 20 - c.max_num))""",
    "neighbors": """SELECT query, genome, neighbor, num, CAST(num - q_num + CASE WHEN before THEN -max_num WHEN after THEN max_num ELSE 0 END AS BIGINT) AS distance,
  CAST(CASE WHEN before THEN start - max_stop WHEN after THEN max_stop + start ELSE start END - q_start AS BIGINT) AS rel_start,
  CAST(CASE WHEN before THEN start - max_stop WHEN after THEN max_stop + start ELSE start END - q_start + abs(stop - start) AS BIGINT) AS rel_stop,
  CAST(trunc(abs(stop - start) / 3 - 1) AS BIGINT) AS seq_len, CASE WHEN normal THEN 'normal' ELSE 'complement' END AS direction, CASE WHEN q_normal THEN 'normal' ELSE 'complement' END AS query_direction,
  CASE WHEN linear THEN 'linear' ELSE 'circular' END AS type, CASE WHEN family = 'error' THEN 'none' ELSE family END AS family FROM near WHERE neighbor <> query""",
    "clustered": "SELECT accession AS query, cluster_num FROM asked",
    "famnb": "SELECT cluster_num, family, count(DISTINCT query) AS num_queries, count(*) AS num_neighbors, floor(100 * CAST(sum(abs(distance)) AS BIGINT) / count(*)) / 100 AS average_distance, floor(median(abs(distance)) * 100) / 100 AS median_distance FROM clustered JOIN neighbors USING (query) GROUP BY cluster_num, family",
    "denom": "SELECT cluster_num, count(DISTINCT query) AS num_seqs, count(DISTINCT CASE WHEN query IN (SELECT query FROM neighbors) THEN query END) AS num_with_neighbors FROM clustered GROUP BY cluster_num",
    "cooc": "SELECT f.*, num_seqs, num_with_neighbors, floor(100 * num_queries / num_with_neighbors) / 100 AS cooccurrence FROM famnb f JOIN denom USING (cluster_num) WHERE num_seqs >= 2 AND floor(100 * num_queries / num_with_neighbors) / 100 >= 0.3",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "labels")


def _needed(body: str) -> list[str]:
    """Views that a text names, with those they need, in order of definition."""
    import re

    both, found = VIEWS | ORACLE_VIEWS, set()

    def add(text: str) -> None:
        for name in both:
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                add(both[name])

    add(body)
    return [n for n in both if n in found]


def oracle(body: str) -> str:
    """DuckDB SQL of a query over the views."""
    both = VIEWS | ORACLE_VIEWS
    ctes = ", ".join(f"{n} AS ({both[n]})" for n in _needed(body))
    return f"WITH RECURSIVE {ctes} {body}" if ctes and not body.lstrip().upper().startswith("WITH") else body


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role as a DataFrame; only the tables it needs are read."""
    import re

    text = " ".join(VIEWS[n] for n in _needed(f"SELECT * FROM {name}") if n in VIEWS)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)}
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in _needed(name) if n in VIEWS)
    for t in frames:
        ctes = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", ctes)
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}", **frames)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, where engines differ in the last bits."""
    return df.select([F.round(c, places).alias(c) if isinstance(df.schema[c].dataType, T.DoubleType) else F.col(c) for c in df.columns])
