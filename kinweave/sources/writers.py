"""Writers; rows become text in columns, nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_edges(edges: DataFrame, path: str) -> None:
    """Parquet with zstd, ranges of falling score, sorted within."""
    edges.repartitionByRange(F.desc("alignment_score")).sortWithinPartitions(F.desc("alignment_score"), "qseqid", "sseqid").write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_tab(rows: DataFrame, path: str, header: bool = False) -> None:
    """Tab-separated files, with a header line if asked for."""
    rows.write.mode("overwrite").csv(path, sep="\t", header=header, quote="", emptyValue="")


def fasta_text(id: Column, sequence: Column, fold: int = 0) -> Column:
    """One FASTA record of each row as text, folded if a width is given."""
    body = F.regexp_replace(F.regexp_replace(sequence, f"(.{{{fold}}})", "$1\n"), "\n$", "") if fold else sequence
    return F.concat(F.lit(">"), id, F.lit("\n"), body)


def write_fasta(sequences: DataFrame, path: str, id: str = "seq_id", sequence: str = "sequence", fold: int = 0) -> None:
    """``>id`` and the sequence, folded on request."""
    sequences.select(fasta_text(F.col(id), F.col(sequence), fold).alias("value")).write.mode("overwrite").text(path)


def long_metadata(wide: DataFrame, id: str = "id") -> DataFrame:
    """Wide metadata as sorted ``id, attribute, value``; nulls go."""
    names = [c for c in wide.columns if c != id]
    texts = wide.select(F.col(id).cast("string").alias("id"), *[F.col(c).cast("string").alias(c) for c in names])
    return texts.unpivot("id", names, "attribute", "value").filter("value IS NOT NULL").sort("id", "attribute")


def write_metadata(wide: DataFrame, path: str, id: str = "id") -> None:
    """Wide attributes as long ``id, attribute, value`` rows in order; nulls go."""
    rows = long_metadata(wide, id).select(F.col("id").alias("UniProt_ID"), F.col("attribute").alias("Attribute"), F.col("value").alias("Value"))
    rows.write.mode("overwrite").csv(path, sep="\t", header=True)


def xml_escape(text: Column) -> Column:
    """Text for an XML attribute; control characters go."""
    out = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _attribute_xml(a: Column) -> Column:
    one = lambda name, kind, value: F.concat(F.lit('<att name="'), xml_escape(name), F.lit('" type="'), kind, F.lit('" value="'), xml_escape(F.coalesce(value, F.lit(""))), F.lit('"/>'))
    listed = F.concat(F.lit('<att type="list" name="'), xml_escape(a["name"]), F.lit('">'), F.array_join(F.transform(a["values"], lambda v: one(a["name"], F.lit("string"), v)), ""), F.lit("</att>"))
    return F.when(a["type"] == "list", listed).otherwise(one(a["name"], a["type"], F.get(a["values"], F.lit(0))))


def network_rows(nodes: DataFrame, edges: DataFrame, name: str = "network") -> list[tuple[str, DataFrame]]:
    """Parts of an XML graph in order, each with a column ``value`` of one element a row: header, nodes, edges, footer."""
    spark = nodes.sparkSession
    body = F.array_join(F.transform("attributes", _attribute_xml), "")
    node = F.concat(F.lit('<node id="'), xml_escape(F.col("id")), F.lit('" label="'), xml_escape(F.coalesce("label", "id")), F.lit('">'), F.coalesce(body, F.lit("")), F.lit("</node>"))
    ends = F.concat_ws(",", "source", "target")
    edge = F.concat(F.lit('<edge id="'), xml_escape(ends), F.lit('" label="'), xml_escape(ends), F.lit('" source="'), xml_escape(F.col("source")), F.lit('" target="'), xml_escape(F.col("target")), F.lit('">'), F.coalesce(body, F.lit("")), F.lit("</edge>"))
    one = lambda text: spark.range(1).select(text.alias("value")).coalesce(1)
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<graph label="'), xml_escape(F.lit(name)), F.lit('" xmlns="http://www.cs.rpi.edu/XGMML">'))
    rows = lambda df, text: df.select(text.alias("value")).filter("value IS NOT NULL")
    return [("0-header", one(head)), ("1-nodes", rows(nodes, node)), ("2-edges", rows(edges, edge)), ("3-footer", one(F.lit("</graph>")))]


def write_network(nodes: DataFrame, edges: DataFrame, path: str, name: str = "network") -> None:
    """An XML graph as folders of text parts and a ``manifest`` of their order; joined in that order they are one document.

    Each part is written as its rows lie, without a shuffle. Nodes without id and edges without
    an end are left out; a null label is the id.
    """
    spark = nodes.sparkSession
    parts = network_rows(nodes, edges, name)
    for folder, rows in parts:
        rows.write.mode("overwrite").text(f"{path}/{folder}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    # A line for each file that the tasks wrote.
    files = [f"{folder}/{n}" for folder, _ in parts for n in sorted(x.getPath().getName() for x in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"))) if not n.startswith(("_", "."))]
    spark.createDataFrame([(i, f) for i, f in enumerate(files)], "i int, value string").coalesce(1).sort("i").select("value").write.mode("overwrite").text(f"{path}/manifest")


def id_list_rows(ids: DataFrame) -> DataFrame:
    """``kind, cluster_num, value``: each id in its cluster's list and in the list ``All``. ``ids``: ``kind, cluster_num, id``."""
    lists = F.explode(F.array(F.col("cluster_num").cast("string"), F.lit("All"))).alias("cluster_num")
    return ids.select("kind", lists, F.col("id").alias("value")).distinct()


def write_id_lists(ids: DataFrame, path: str) -> None:
    """One list per cluster and kind, and one for all; each list is written by few tasks."""
    id_list_rows(ids).repartition("kind", "cluster_num", F.pmod(F.hash("value"), F.lit(8))).sortWithinPartitions("kind", "cluster_num", "value").write.mode("overwrite").partitionBy("kind", "cluster_num").text(path)


def write_cluster_fasta(ids: DataFrame, sequences: DataFrame, path: str) -> None:
    """One FASTA folder per cluster. ``ids``: ``cluster_num, id``; ``sequences``: ``seq_id, sequence``."""
    rows = cluster_fasta_rows(ids, sequences)
    rows.repartition("cluster_num", F.pmod(F.hash("value"), F.lit(8))).write.mode("overwrite").partitionBy("cluster_num").text(path)


def cluster_fasta_rows(ids: DataFrame, sequences: DataFrame) -> DataFrame:
    """FASTA records with their cluster, for files by cluster."""
    both = ids.select("cluster_num", "id").distinct().join(sequences.select(F.col("seq_id").alias("id"), "sequence"), "id")
    return both.select("cluster_num", fasta_text(F.col("id"), F.col("sequence")).alias("value"))
