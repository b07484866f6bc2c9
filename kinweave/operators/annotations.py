"""Annotations of sequences, and the node and edge tables of a network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.chunks import chunked

#: Separators of member rows and of list items in text output.
ROW_SEP, LIST_SEP = "^", ","


def annotate(accessions: DataFrame, annotations: DataFrame, taxonomy: DataFrame, families: DataFrame, interpro: DataFrame) -> DataFrame:
    """Annotations, taxonomy, distinct families and InterPro ids with types of each accession.

    ``families``: ``accession, family``; ``interpro``: ``accession, family, family_type``. Both are
    gathered per accession first, so that joining two one-to-many tables multiplies nothing.
    """
    fams = families.groupBy("accession").agg(F.array_sort(F.collect_set("family")).alias("families"))
    ipro = interpro.groupBy("accession").agg(F.array_sort(F.collect_set(F.struct("family", "family_type"))).alias("interpro"))
    rows = accessions.select("accession").distinct().join(annotations, "accession").join(taxonomy, "taxonomy_id", "left")
    empty = F.array().cast("array<string>")
    out = rows.join(fams, "accession", "left").join(ipro, "accession", "left").withColumn("families", F.coalesce("families", empty))
    return out.withColumns({"interpro_ids": F.coalesce(F.transform("interpro", lambda x: x["family"]), empty), "interpro_types": F.coalesce(F.transform("interpro", lambda x: x["family_type"]), empty)}).drop("interpro")


def decode_metadata(rows: DataFrame, fields: dict[str, str], metadata: str = "metadata") -> DataFrame:
    """JSON documents as named columns: ``fields`` maps short keys to names; blank documents give nulls."""
    doc = F.from_json(F.when(~F.col(metadata).rlike(r"^\s*$"), F.col(metadata)), "map<string,string>")
    return rows.withColumns({name: F.try_element_at(doc, F.lit(key)) for key, name in fields.items()}).drop(metadata)


#: InterPro types that have a list of their own.
FAMILY_TYPES = ("domain", "family", "homologous_superfamily")


def split_family_types(interpro: DataFrame) -> DataFrame:
    """``accession`` and the distinct ids of each type, others in ``other``. ``interpro``: ``accession, family, family_type``."""
    kind = F.lower("family_type")
    lists = [F.array_sort(F.collect_set(F.when(kind == t, F.col("family")))).alias(t) for t in FAMILY_TYPES]
    rest = F.array_sort(F.collect_set(F.when(~kind.isin(*FAMILY_TYPES) | kind.isNull(), F.col("family")))).alias("other")
    return interpro.groupBy("accession").agg(*lists, rest)


def _no_tail(text: Column) -> Column:
    return F.regexp_replace(text, r";\s*$", "")


def format_annotations(rows: DataFrame, text: list[str]) -> DataFrame:
    """Display values: status, reviewed description or NA, complete/fragment, True/False, and ``None`` for missing text.

    ``rows``: ``accession, is_reviewed, description, is_fragment, gdna`` and the ``text`` columns.
    """
    shown = {
        "swissprot_status": F.when(F.col("is_reviewed"), "SwissProt").otherwise("TrEMBL"),
        "swissprot_description": F.when(F.col("is_reviewed"), _no_tail(F.col("description"))).otherwise("NA"),
        "is_fragment": F.when(F.col("is_fragment"), "fragment").otherwise("complete"),
        "gdna": F.when(F.col("gdna"), "True").otherwise("False"),
    }
    shown |= {c: F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", "None").otherwise(_no_tail(F.col(c).cast("string"))) for c in text}
    return rows.select("accession", *[v.alias(k) for k, v in shown.items()])


def merge_member_rows(members: DataFrame, rows: DataFrame, fields: list[str], chunk: int | None = None) -> DataFrame:
    """Values of a seed's members joined with ``^``, the seed first, then by id. ``members``: ``seed, accession``.

    A null value is an empty one. With ``chunk``, a seed has rows ``seed, chunk`` and texts of up
    to so many members each, which joined with ``^`` in order of ``chunk`` are the whole.
    """
    both = members.join(rows, "accession")
    late = F.col("accession") != F.col("seed")
    values = F.struct(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    joined = lambda x: [F.array_join(F.transform(x, lambda v: _no_tail(v[f])), ROW_SEP).alias(f) for f in fields]
    if chunk:
        return chunked(both, ["seed"], [late.alias("late"), "accession", values.alias("v")], values, chunk).select("seed", "chunk", *joined("values"))
    parts = F.array_sort(F.collect_list(F.struct(late.alias("_o"), "accession", values.alias("v"))))
    return both.groupBy("seed").agg(parts.alias("p")).select("seed", F.transform("p", lambda x: x["v"]).alias("p")).select("seed", *joined("p"))


def seed_attributes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """Member list, member count and seed length. ``members``: ``seed, accession``."""
    out = members.groupBy("seed").agg(F.array_join(F.array_sort(F.collect_set("accession")), LIST_SEP).alias("members"), F.countDistinct("accession").alias("member_count"))
    return out.join(lengths.select(F.col("seqid").alias("seed"), F.col("sequence_length").alias("seed_length")), "seed", "left")


#: Kinds of foreign ids that nodes show.
SHOWN_KINDS = ("genbank", "ncbi", "embl-cds")


def foreign_ids(ids: DataFrame, mapping: DataFrame, kinds: tuple[str, ...] = SHOWN_KINDS) -> DataFrame:
    """``id, foreign_ids``: sorted ``TYPE:id`` list of the given kinds, empty if none."""
    some = mapping.filter(F.col("foreign_id_type").isin(*kinds)).groupBy(F.col("uniprot_id").alias("id")).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", F.upper("foreign_id_type"), "foreign_id"))), LIST_SEP).alias("foreign_ids"))
    return ids.select(F.col(ids.columns[0]).alias("id")).distinct().join(some, "id", "left").select("id", F.coalesce("foreign_ids", F.lit("")).alias("foreign_ids"))


def node_table(nodes: DataFrame, metadata: DataFrame) -> DataFrame:
    """``node, attribute, values``: distinct sorted values, ``None`` only where nothing else is.

    ``nodes``: ``node`` (may be ``id:start:end``); ``metadata``: long ``id, attribute, value`` with ``^``
    between members and ``,`` within. A domain node gets its length from its bounds.
    """
    parts = nodes.select("node", F.regexp_extract("node", r"^(.*?)(?::(\d+):(\d+))?$", 1).alias("id"), F.regexp_extract("node", r":(\d+):(\d+)$", 1).alias("a"), F.regexp_extract("node", r":(\d+):(\d+)$", 2).alias("b"))
    split = F.array_sort(F.array_distinct(F.filter(F.split("value", r"[\^,]"), lambda x: x != "")))
    values = F.when(F.size(split) > 1, F.filter(split, lambda x: x != "None")).otherwise(split)
    listed = parts.join(metadata, "id").select("node", "attribute", values.alias("values"), "a", "b")
    return listed.select("node", "attribute", F.coalesce(F.when((F.col("attribute") == "Sequence_Length") & (F.col("a") != ""), F.array((F.expr("try_cast(b AS bigint)") - F.expr("try_cast(a AS bigint)") + 1).cast("string"))), "values").alias("values"))


def edge_table(edges: DataFrame) -> DataFrame:
    """Edge id, identity, score and alignment length as a network shows them."""
    return edges.select(F.concat_ws(",", "qseqid", "sseqid").alias("edge_id"), F.col("qseqid").alias("source"), F.col("sseqid").alias("target"), F.col("pident").alias("percent_id"), "alignment_score", "alignment_length")


def repnode_network(clusters: DataFrame, attributes: DataFrame, edges: DataFrame, chunk: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes of identity clusters (size, union of member attributes, ``None`` where empty), and edges between representatives.

    ``clusters``: ``representative, member``; ``attributes``: ``id, attribute, value``. With
    ``chunk``, nodes have a column ``chunk`` and an attribute has rows of up to so many values.
    """
    sizes = clusters.groupBy("representative").agg(F.countDistinct("member").alias("cluster_size"))
    kept = F.when(~F.coalesce(F.col("value"), F.lit("")).isin("", "None"), F.col("value"))
    held = clusters.join(attributes.withColumnRenamed("id", "member"), "member").select("representative", "attribute", kept.alias("value"))
    keys = ["representative", "attribute"]
    if chunk:
        some = chunked(held.filter("value IS NOT NULL").distinct(), keys, ["value"], F.col("value"), chunk)
        none = held.groupBy(*keys).agg(F.count("value").alias("n")).filter("n = 0").select(*keys, F.lit(0).cast("long").alias("chunk"), F.array().cast("array<string>").alias("values"))
        union = some.unionByName(none)
    else:
        union = held.groupBy(*keys).agg(F.array_sort(F.collect_set("value")).alias("values"))
    nodes = union.join(sizes, "representative").select(*keys, *["chunk"] * bool(chunk), F.when(F.size("values") == 0, F.array(F.lit("None"))).otherwise(F.col("values")).alias("values"), "cluster_size")
    reps = sizes.select("representative")
    of = lambda c: reps.withColumnRenamed("representative", c)
    return nodes, edges.join(of("qseqid"), "qseqid", "left_semi").join(of("sseqid"), "sseqid", "left_semi").select(edges.columns)
