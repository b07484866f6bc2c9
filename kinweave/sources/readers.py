"""Readers; every one splits large files by record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.sources import schemas


def read_hits(spark: SparkSession, path: str, every_column: bool = False) -> DataFrame:
    """Tab-separated hits with 12 columns, ``#`` lines skipped; five columns are kept."""
    hits = spark.read.schema(schemas.HITS).csv(path, sep="\t", comment="#")
    return hits if every_column else hits.select(schemas.HIT_COLUMNS)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``seq_no, seq_id, header, sequence, length`` of each record; ``seq_no`` follows the order of the file.

    Records split on a line that begins with ``>``; wrapped lines and carriage returns are joined.
    """
    raw = spark.read.text(path, lineSep="\n>").withColumn("seq_no", F.monotonically_increasing_id())
    text = F.regexp_replace(F.regexp_replace("value", r"^>", ""), r"\r", "")
    rows = raw.select("seq_no", text.alias("r")).filter(F.trim("r") != "")
    cut = F.instr("r", "\n")
    header = F.trim(F.when(cut > 0, F.substring_index("r", "\n", 1)).otherwise(F.col("r")))
    sequence = F.when(cut > 0, F.regexp_replace(F.substr("r", cut + 1), r"\s", "")).otherwise("")
    return rows.select("seq_no", F.regexp_extract(header, r"^\S*", 0).alias("seq_id"), header.alias("header"), sequence.alias("sequence")).withColumn("length", F.length("sequence").cast("long"))


def read_identity_clusters(spark: SparkSession, path: str) -> DataFrame:
    """``representative, member`` of a cluster listing; ids may carry ``:start:end``, ``*`` marks the representative."""
    raw = spark.read.text(path, lineSep="\n>Cluster").withColumn("c", F.monotonically_increasing_id())
    line = F.explode(F.split("value", "\n")).alias("line")
    rows = raw.select("c", line).select("c", F.regexp_extract("line", r">(\S+?)\.\.\.", 1).alias("member"), F.col("line").rlike(r"\*\s*$").alias("rep")).filter("member != ''")
    reps = rows.filter("rep").select("c", F.col("member").alias("representative"))
    return rows.join(reps, "c").select("representative", "member")


def read_metadata(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """Long ``id, attribute, value`` table with a header line; comment and blank lines go, other ids too if a list is given."""
    raw = spark.read.schema(schemas.METADATA).csv(path, sep="\t", comment="#", header=False)
    rows = raw.filter("UniProt_ID IS NOT NULL AND UniProt_ID != '' AND UniProt_ID != 'UniProt_ID'").select(F.col("UniProt_ID").alias("id"), F.col("Attribute").alias("attribute"), F.col("Value").alias("value"))
    return rows if ids is None else rows.join(ids.select(F.col(ids.columns[0]).alias("id")), "id", "left_semi")


def _attributes(att):
    scalar = F.transform(F.filter(att, lambda a: a["_type"] != "list"), lambda a: F.struct(a["_name"].alias("name"), a["_type"].alias("type"), F.array(a["_value"]).alias("values")))
    lists = F.transform(F.filter(att, lambda a: a["_type"] == "list"), lambda a: F.struct(a["_name"].alias("name"), F.lit("list").alias("type"), F.transform(a["att"], lambda x: x["_value"]).alias("values")))
    return F.coalesce(F.concat(scalar, lists), F.array().cast("array<struct<name:string,type:string,values:array<string>>>"))


def read_network(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes ``id, label, attributes`` and edges ``source, target, attributes`` of an XML graph.

    Of a graph with a manifest of its parts, nodes are read from the node parts and edges from
    the edge parts, so each file is scanned once; of other files each table is a scan.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    parted = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    of = lambda tag, schema, part: spark.read.format("xml").option("useLegacyXMLParser", True).option("rowTag", tag).schema(schema).load(f"{path}/{part}" if parted else path)
    nodes, edges = of("node", schemas.NODE, "1-nodes"), of("edge", schemas.EDGE, "2-edges")
    wide = F.transform("att", lambda a: F.struct(a["_name"].alias("_name"), a["_type"].alias("_type"), a["_value"].alias("_value"), F.lit(None).cast("array<struct<_name:string,_type:string,_value:string>>").alias("att")))
    return nodes.select(F.col("_id").alias("id"), F.col("_label").alias("label"), _attributes(F.col("att")).alias("attributes")), edges.select(F.col("_source").alias("source"), F.col("_target").alias("target"), _attributes(wide).alias("attributes"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a free list, split at white space and commas."""
    return spark.read.text(path).select(F.explode(F.split("value", r"[\s,]+")).alias("id")).filter("id != ''").distinct()


def _even_predicates(spark: SparkSession, uri: str, table: str, column: str, parts: int, options: dict[str, str]) -> list[str]:
    """Conditions that cut a table into ranges of a whole-number column; the bounds come from one query, nulls go to the first range."""
    column = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(uri).quoteIdentifier(column)
    query = f"SELECT min({column}) AS a, max({column}) AS b FROM {table}"
    ends = spark.read.format("jdbc").options(url=uri, query=query, **options).load().toDF("a", "b").first()
    if ends.a is None:
        return ["1 = 1"]
    a, b = int(ends.a), int(ends.b)
    cuts = sorted({a + (b - a + 1) * i // parts for i in range(1, parts)} - {a})
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {x} AND {column} < {y}" for x, y in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_reference_tables(spark: SparkSession, uri: str, names: list[str], partition_columns: dict[str, str] | None = None, parts: int = 8, **jdbc: str) -> dict[str, DataFrame]:
    """Lookup tables by name: Parquet below a folder, or tables of a relational database for a ``jdbc:`` address.

    Database tables with a column of whole numbers in ``partition_columns`` are read by
    ``parts`` tasks, each a range of it; others by one task. Every row is read once, rows with
    a null there too. ``jdbc`` holds further options such as ``driver`` and ``user``.
    """
    if not uri.startswith("jdbc:"):
        return {n: spark.read.parquet(f"{uri}/{n}.parquet") for n in names}
    out = {}
    for n in names:
        if n in (partition_columns or {}):
            predicates = _even_predicates(spark, uri, n, partition_columns[n], parts, jdbc)
            out[n] = spark.read.jdbc(uri, n, predicates=predicates, properties=jdbc)
        else:
            out[n] = spark.read.format("jdbc").options(url=uri, dbtable=n, **jdbc).load()
    return out
