"""From similarity hits to reduced, scored and filtered edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.operators.similarity import all_by_all_similarity, least_shared  # noqa: F401

EDGE_MAX = 10_000_000
#: Representatives that are broadcast at most.
KNOWN = 100_000


def drop_self_hits(hits: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """Hits between different ids; a null end drops the hit."""
    return hits.filter(F.col(q) != F.col(s))


def canonicalize_pairs(hits: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """Ids in upper case, the smaller one first."""
    a, b = F.upper(q), F.upper(s)
    return hits.withColumns({q: F.least(a, b), s: F.greatest(a, b)})


def best_hit_per_pair(hits: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """One row per pair: highest bit score, then smallest identity, then shortest alignment.

    Other columns go. Partial aggregation drops duplicates before the shuffle.
    """
    best = F.min(F.struct((-F.col("bitscore")).alias("b"), "pident", "alignment_length")).alias("x")
    return hits.groupBy(q, s).agg(best).select(q, s, "x.pident", "x.alignment_length", (-F.col("x.b")).alias("bitscore"))


def attach_lengths(edges: DataFrame, lengths: DataFrame, q: str = "qseqid", s: str = "sseqid", seqid: str = "seqid", length: str = "sequence_length") -> DataFrame:
    """Adds ``query_length`` and ``subject_length``; null where the id has no length.

    Lengths are unique by id. Hub ids are skewed: the planner broadcasts small tables and
    splits skewed partitions otherwise.
    """
    of = lambda c, name: lengths.select(F.col(seqid).alias(c), F.col(length).alias(name))
    return edges.join(of(q, "query_length"), q, "left").join(of(s, "subject_length"), s, "left").select(*edges.columns, "query_length", "subject_length")


def alignment_score(query_length: Column, subject_length: Column, bitscore: Column, rounding: str = "floor") -> Column:
    """``-log10(ql * sl) + log10(2) * bitscore`` as an int, rounded down or cut (``trunc``)."""
    x = -F.log10(query_length.cast("double") * subject_length.cast("double")) + F.log10(F.lit(2.0)) * bitscore
    return F.floor(x).cast("int") if rounding == "floor" else F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("int")


def add_alignment_score(edges: DataFrame, rounding: str = "floor") -> DataFrame:
    """Adds ``alignment_score``: the bit score less the logarithm of both lengths, as int, rounded down (``trunc``: toward zero); null if a length is missing."""
    return edges.withColumn("alignment_score", alignment_score(F.col("query_length"), F.col("subject_length"), F.col("bitscore"), rounding))


def reduce_edges(hits: DataFrame, lengths: DataFrame, rounding: str = "floor") -> DataFrame:
    """Hits to one scored edge per unordered pair."""
    pairs = best_hit_per_pair(canonicalize_pairs(drop_self_hits(hits)))
    return add_alignment_score(attach_lengths(pairs, lengths), rounding)


def top_hits_per_query(hits: DataFrame, k: int = 250, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """The ``k`` hits of each query with the highest bit score, ties to the smaller subject."""
    w = Window.partitionBy(q).orderBy(F.desc("bitscore"), s, F.desc("pident"), "alignment_length")
    return hits.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def filter_edges(edges: DataFrame, param: str, min_val: float, min_len: int = 0, max_len: int = 0) -> DataFrame:
    """Edges with ``param >= min_val`` and both lengths within the bounds (0: no upper bound)."""
    if param not in ("pident", "bitscore", "alignment_score"):
        raise ValueError(param)
    keep = F.col(param) >= min_val
    for c in ("query_length", "subject_length"):
        keep = keep & (F.col(c) >= min_len)
        if max_len:
            keep = keep & (F.col(c) <= max_len)
    return edges.filter(keep)


def filter_edges_by_ids(edges: DataFrame, ids: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """Edges both of whose ends are in the first column of ``ids``."""
    of = lambda c: ids.select(F.col(ids.columns[0]).alias(c))
    return edges.join(of(q), q, "left_semi").join(of(s), s, "left_semi")


def filter_edges_within_groups(edges: DataFrame, groups: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """Edges whose ends lie in one user-given group; ``groups`` has ``id, group`` with unique ids."""
    of = lambda c, g: groups.select(F.col("id").alias(c), F.col("group").alias(g))
    return edges.join(of(q, "_g1"), q).join(of(s, "_g2"), s).filter("_g1 = _g2").withColumnRenamed("_g1", "group").select(*edges.columns, "group")


def edge_limit(edges: DataFrame, max_edges: int | None = None) -> DataFrame:
    """One row ``fits, num_edges``: whether there are at most ``max_edges`` (none given: ``EDGE_MAX``), and the number of all edges."""
    n = F.count("*")
    return edges.agg((n <= (EDGE_MAX if max_edges is None else max_edges)).alias("fits"), n.alias("num_edges"))


def guard_edge_count(edges: DataFrame, max_edges: int | None = None) -> tuple[bool, DataFrame]:
    """Whether there are at most ``max_edges``, and the edges (none if there are more)."""
    fits = edge_limit(edges, max_edges).first().fits
    return fits, edges if fits else edges.limit(0)


def multiplex(sequences: DataFrame, seq_id: str = "seq_id", sequence: str = "sequence") -> DataFrame:
    """``representative, member`` of groups of identical sequences; the smallest id represents."""
    keyed = sequences.select(F.col(seq_id).alias("member"), F.sha2(sequence, 256).alias("k"), F.length(sequence).alias("n"))
    reps = keyed.groupBy("k", "n").agg(F.min("member").alias("representative"))
    return keyed.join(reps, ["k", "n"]).select("representative", "member")


def demultiplex(edges: DataFrame, members: DataFrame, q: str = "qseqid", s: str = "sseqid") -> DataFrame:
    """Each edge between representatives as edges between all their members.

    A self edge gives all pairs i < j of its members; edges with an unknown end go, and do so
    where they are read: up to ``KNOWN`` representatives are broadcast, behind their count.
    """
    known = Staging(members.sparkSession, "members").write(members.select("representative").filter("representative IS NOT NULL").distinct(), "representatives")
    few = known.count() <= KNOWN
    for c in (q, s):
        end = known.withColumnRenamed("representative", c)
        edges = edges.join(F.broadcast(end) if few else end, c, "left_semi").select(edges.columns)
    of = lambda c, m: members.select(F.col("representative").alias(c), F.col("member").alias(m))
    both = edges.join(of(q, "_mq"), q).join(of(s, "_ms"), s).filter((F.col(q) != F.col(s)) | (F.col("_mq") < F.col("_ms")))
    return both.withColumns({q: F.col("_mq"), s: F.col("_ms")}).select(edges.columns)


def append_representative_info(members: DataFrame) -> DataFrame:
    """Sorted member list and member count of each representative."""
    return members.groupBy("representative").agg(F.array_sort(F.collect_set("member")).alias("members"), F.countDistinct("member").alias("member_count"))


def blast_hit_table(hits: DataFrame, metadata: DataFrame, s: str = "sseqid") -> DataFrame:
    """``id, evalue, description, member_count`` of hit ids, best e-value first.

    ``metadata`` has ``id, swissprot_description, description, member_count``; the reviewed text
    is preferred unless it is empty or ``NA``; parts joined with ``^`` are made distinct.
    """
    best = hits.groupBy(F.col(s).alias("id")).agg(F.min("evalue").alias("evalue"))
    reviewed = F.when(~F.coalesce(F.col("swissprot_description"), F.lit("")).isin("", "NA", "None"), F.col("swissprot_description"))
    text = F.array_join(F.array_distinct(F.split(F.coalesce(reviewed, "description"), r"\^")), "^")
    return best.join(metadata, "id", "left").select("id", "evalue", text.alias("description"), F.coalesce("member_count", F.lit(1)).cast("long").alias("member_count")).orderBy("evalue", "id")
