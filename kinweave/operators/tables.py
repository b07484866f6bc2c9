"""Building lookup tables from public flat and XML files.

Parsers take one text column of whole records, so that files split by record when read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.functions.ranking import running_max


def read_flat_records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: records that end with a line ``//``."""
    return spark.read.text(path, lineSep="\n//\n").filter(F.trim("value") != "")


def _line(code: str, pattern: str, record: str = "value") -> Column:
    return F.nullif(F.regexp_extract(record, rf"(?m)^{code}   {pattern}", 1), F.lit(""))


def _lines(code: str, record: str = "value") -> Column:
    return F.array_join(F.regexp_extract_all(record, F.lit(rf"(?m)^{code}   (.*)$"), 1), " ")


def parse_protein_records(records: DataFrame) -> DataFrame:
    """Annotation rows of protein flat records (one string column ``value``)."""
    ref = lambda db: F.array_join(F.array_distinct(F.regexp_extract_all("value", F.lit(rf"(?m)^DR   {db}; ([^;\s]+);"), 1)), ",")
    names = _lines("DE")
    name = F.coalesce(F.nullif(F.regexp_extract(names, r"RecName: Full=([^;]+);", 1), F.lit("")), F.nullif(F.regexp_extract(names, r"SubName: Full=([^;]+);", 1), F.lit("")))
    return records.select(
        _line("AC", r"([A-Z0-9]+);").alias("accession"), _line("ID", r"(\S+)").alias("id"), (_line("ID", r"\S+\s+(\w+);") == "Reviewed").alias("is_reviewed"),
        F.regexp_extract("value", r"(?m)^ID   .*?(\d+) AA\.", 1).try_cast("int").alias("length"), _line("OX", r"NCBI_TaxID=(\d+)").try_cast("int").alias("taxonomy_id"),
        F.array_join(F.array_distinct(F.regexp_extract_all(names, F.lit(r"EC=([0-9n.\-]+)"), 1)), ",").alias("ec"),
        ref("PDB").alias("pdb"), ref("Pfam").alias("pfam"), ref("InterPro").alias("interpro"), ref("GO").alias("go"), ref("KEGG").alias("kegg"), ref("STRING").alias("string"),
        _line("GN", r".*?Name=([^;{]+?)\s*[;{]").alias("gene"), F.regexp_replace(_lines("OS"), r"\.\s*$", "").alias("organism"),
        F.trim(F.regexp_replace(name, r"\s*\{[^}]*\}", "")).alias("description"), names.rlike(r"Flags:[^;]*Fragment").alias("is_fragment"))


def attach_taxon_flags(annotations: DataFrame, genome_taxa: DataFrame, body_sites: DataFrame) -> DataFrame:
    """Adds ``gdna``, ``sites`` and ``oxygen``. ``genome_taxa``: ``taxonomy_id``; ``body_sites``: ``taxonomy_id, site, oxygen``."""
    flags = genome_taxa.select("taxonomy_id").distinct().withColumn("gdna", F.lit(True))
    sites = body_sites.groupBy("taxonomy_id").agg(F.array_sort(F.collect_set("site")).alias("sites"), F.array_sort(F.collect_set("oxygen")).alias("oxygen"))
    out = annotations.join(flags, "taxonomy_id", "left").join(sites, "taxonomy_id", "left")
    empty = F.array().cast("array<string>")
    return out.withColumns({"gdna": F.coalesce("gdna", F.lit(False)), "sites": F.coalesce("sites", empty), "oxygen": F.coalesce("oxygen", empty)})


#: Schema of one protein of a match file.
MATCH_SCHEMA = "_id string, match array<struct<_id:string,_dbname:string,_name:string,ipr:struct<_id:string,_name:string,_type:string,_parent_id:string>,lcn:array<struct<_start:int,_end:int>>>>"


def read_family_matches(spark: SparkSession, path: str) -> DataFrame:
    """Protein elements of a family match file, one row each, with nested matches."""
    return spark.read.format("xml").option("useLegacyXMLParser", True).option("rowTag", "protein").schema(MATCH_SCHEMA).load(path)


def parse_family_matches(proteins: DataFrame, hierarchy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Family rows ``database, id, accession, start, end`` and InterPro rows with type, parent and leaf flag.

    ``hierarchy``: ``family, parent, is_leaf``.
    """
    m = proteins.select(F.col("_id").alias("accession"), F.explode("match").alias("m")).select("accession", "m.*").select("accession", "_id", "_dbname", "ipr", F.explode("lcn").alias("l"))
    families = m.select(F.col("_dbname").alias("database"), F.col("_id").alias("id"), "accession", F.col("l._start").alias("start"), F.col("l._end").alias("end"))
    ipro = m.filter("ipr._id IS NOT NULL").select(F.col("ipr._id").alias("id"), "accession", F.col("l._start").alias("start"), F.col("l._end").alias("end"), F.col("ipr._type").alias("family_type"))
    tree = hierarchy.select(F.col("family").alias("id"), "parent", "is_leaf")
    return families, ipro.join(tree, "id", "left").withColumn("is_leaf", F.coalesce("is_leaf", F.lit(True)))


def family_hierarchy(lines: DataFrame, order: str = "line_no", line: str = "line", max_depth: int = 32) -> DataFrame:
    """``family, parent, is_leaf, depth`` from a tree listing whose depth is the number of leading dashes.

    The parent is the last earlier line that is one step less deep. Depth 0 begins a tree, so
    trees are told apart by the line of their root and the windows run within one tree each.
    """
    rows = lines.select(F.col(order).alias("n"), F.regexp_extract(line, r"^-*", 0).alias("d"), F.regexp_extract(line, r"^-*([^:\s]+)", 1).alias("family")).filter("family != ''")
    rows = rows.withColumn("depth", (F.length("d") / 2).cast("int"))
    roots = running_max(rows, F.when(F.col("depth") == 0, F.col("n")), "n", "tree")
    w = Window.partitionBy("tree").orderBy("n")
    before = lambda k: F.last(F.when(F.col("depth") == k, F.col("family")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    parent = F.coalesce(*[F.when(F.col("depth") == k + 1, before(k)) for k in range(max_depth)])
    deeper = F.lead("depth").over(w)
    return roots.select("family", parent.alias("parent"), (F.coalesce(deeper, F.lit(0)) <= F.col("depth")).alias("is_leaf"), "depth")


def family_info(names: DataFrame, counts: DataFrame, hierarchy: DataFrame | None = None, clans: DataFrame | None = None) -> DataFrame:
    """Names, counts, type and parent of families; clans appended with their own counts. ``names``: ``family, short_name, long_name, family_type``."""
    out = names.join(counts, "family", "left")
    out = out.withColumn("parent", F.lit(None).cast("string")) if hierarchy is None else out.join(hierarchy.select("family", "parent"), "family", "left")
    cols = ["family", "short_name", "long_name", "family_type", "parent", "num_members", "num_seed50", "num_seed90"]
    out = out.select(cols)
    if clans is None:
        return out
    sums = clans.join(counts, "family").groupBy(F.col("clan").alias("family")).agg(*[F.sum(c).alias(c) for c in cols[-3:]])
    return out.unionByName(sums.select("family", F.col("family").alias("short_name"), F.col("family").alias("long_name"), F.lit("clan").alias("family_type"), F.lit(None).cast("string").alias("parent"), *cols[-3:]))


_MEMBER = "struct<_type:string,_id:string,property:array<struct<_type:string,_value:string>>>"
#: Schema of one entry of a seed cluster file.
SEED_SCHEMA = f"_id string, representativeMember struct<dbReference:{_MEMBER}>, member array<struct<dbReference:{_MEMBER}>>"


def read_seed_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Entry elements of a seed cluster file, one row each."""
    return spark.read.format("xml").option("useLegacyXMLParser", True).option("rowTag", "entry").schema(SEED_SCHEMA).load(path)


def parse_seed_clusters(entries: DataFrame) -> DataFrame:
    """``seed, member`` with the seed itself; an isoform suffix goes, entries without accession are skipped."""
    acc = lambda r: F.regexp_replace(F.get(F.transform(F.filter(r["property"], lambda p: p["_type"] == "UniProtKB accession"), lambda p: p["_value"]), F.lit(0)), r"-\d+$", "")
    seed = acc(F.col("representativeMember.dbReference"))
    rows = entries.select(seed.alias("seed"), F.transform("member", lambda m: acc(m["dbReference"])).alias("ms")).filter("seed IS NOT NULL")
    members = F.array_distinct(F.filter(F.concat(F.array("seed"), F.coalesce("ms", F.array().cast("array<string>"))), lambda x: x.isNotNull()))
    return rows.select("seed", F.explode(members).alias("member")).distinct()


def merge_seed_tables(seeds50: DataFrame, seeds90: DataFrame) -> DataFrame:
    """``accession, seed50, seed90``, empty where a level lacks the member. Both: ``seed, member``."""
    a = seeds50.select(F.col("member").alias("accession"), F.col("seed").alias("seed50"))
    b = seeds90.select(F.col("member").alias("accession"), F.col("seed").alias("seed90"))
    return a.join(b, "accession", "full_outer").select("accession", F.coalesce("seed50", F.lit("")).alias("seed50"), F.coalesce("seed90", F.lit("")).alias("seed90"))


#: Ranks of the taxonomy table, in order, and their names in files.
RANKS = {"domain": "superkingdom", "kingdom": "kingdom", "phylum": "phylum", "class": "class", "tax_order": "order", "family": "family", "genus": "genus", "species": "species"}
_TAXON = "struct<_taxId:int,_scientificName:string,_rank:string>"
#: Schema of one taxon.
TAXON_SCHEMA = f"_taxId int, _scientificName string, _rank string, lineage struct<taxon:array<{_TAXON}>>, children struct<taxon:array<{_TAXON}>>"


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxon elements of a taxonomy file, one row each, with nested lineage and children."""
    return spark.read.format("xml").option("useLegacyXMLParser", True).option("rowTag", "entry").schema(f"taxon struct<{TAXON_SCHEMA.replace('_taxId int', '_taxId:int').replace('_scientificName string', '_scientificName:string').replace('_rank string', '_rank:string').replace('lineage struct', 'lineage:struct').replace('children struct', 'children:struct')}>").load(path).select("taxon.*")


def parse_taxonomy(taxa: DataFrame) -> DataFrame:
    """One row with 8 ranks per taxon and per child without rank of its own (one rank below its parent); ``NA`` by default.

    A taxon that comes both by itself and as a child keeps its own row; of several own rows, or
    of several rows as a child, the smallest. Taxa without id go.
    """
    lineage = F.filter(F.coalesce("lineage.taxon", F.array().cast(f"array<{_TAXON}>")), lambda t: t["_rank"].isNotNull())
    ranks = F.map_from_entries(F.array_distinct(F.transform(F.array_distinct(F.transform(lineage, lambda t: t["_rank"])), lambda r: F.struct(r.alias("k"), F.get(F.transform(F.filter(lineage, lambda t: t["_rank"] == r), lambda t: t["_scientificName"]), F.lit(0)).alias("v")))))
    own = taxa.select(F.col("_taxId").alias("taxonomy_id"), F.col("_scientificName").alias("name"), F.col("_rank").alias("rank"), ranks.alias("r"), F.coalesce("children.taxon", F.array().cast(f"array<{_TAXON}>")).alias("c"))
    names = list(RANKS.values())
    below = reduce(lambda out, i: F.when(F.col("rank") == names[i], names[i + 1]).otherwise(out), range(len(names) - 1), F.lit("species"))
    kids = own.select(F.explode("c").alias("k"), "name", "rank", "r", below.alias("next"))
    child = kids.select(F.col("k._taxId").alias("taxonomy_id"), F.col("k._scientificName").alias("name"), F.coalesce("k._rank", "next").alias("rank"), F.map_concat(F.map_filter("r", lambda k, v: k != F.coalesce(F.col("rank"), F.lit(""))), F.when(F.col("rank").isNotNull(), F.create_map("rank", "name")).otherwise(F.create_map().cast("map<string,string>"))).alias("r"))
    rows = own.drop("c").withColumn("as_child", F.lit(0)).unionByName(child.withColumn("as_child", F.lit(1))).filter("taxonomy_id IS NOT NULL")
    value = lambda name: F.coalesce(F.when(F.col("rank") == name, F.col("name")), F.try_element_at("r", F.lit(name)), F.lit("NA"))
    one = F.min(F.struct("as_child", *[value(v).alias(k) for k, v in RANKS.items()])).alias("x")
    return rows.groupBy("taxonomy_id").agg(one).select("taxonomy_id", *[f"x.{k}" for k in RANKS])


def parse_gene_records(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """Gene rows ``genome, accession, num, linear, normal, start, stop`` of genome flat records.

    The ordinal counts coding regions; the protein comes from a cross reference, else from the
    protein id through ``mapping``: ``foreign_id, uniprot_id``.
    """
    genome = F.regexp_extract("value", r"(?m)^ID   (\w+)", 1)
    circular = F.col("value").rlike(r"(?m)^ID   [^\n]*circular")
    parts = F.slice(F.split("value", r"\nFT   CDS +"), 2, 1_000_000)
    rows = records.select(genome.alias("genome"), (~circular).alias("linear"), F.posexplode(parts).alias("i", "cds"))
    place = F.regexp_extract("cds", r"^([^\n]*)", 1)
    rows = rows.select("genome", "linear", (F.col("i") + 1).alias("num"), (~place.contains("complement")).alias("normal"), F.regexp_extract(place, r"(\d+)", 1).try_cast("int").alias("start"), F.regexp_extract(place, r".*\.\.>?(\d+)", 1).try_cast("int").alias("stop"), F.nullif(F.regexp_extract("cds", r'/db_xref="UniProtKB/[^:]+:(\w+)"', 1), F.lit("")).alias("own"), F.nullif(F.regexp_extract("cds", r'/protein_id="([^".]+)', 1), F.lit("")).alias("foreign_id"))
    table = mapping.groupBy("foreign_id").agg(F.min("uniprot_id").alias("mapped"))
    out = rows.join(table, "foreign_id", "left").withColumn("accession", F.coalesce("own", "mapped"))
    return out.filter("accession IS NOT NULL").select("genome", "accession", "num", "linear", "normal", "start", "stop")


def filter_id_mapping(mapping: DataFrame, types: list[str]) -> DataFrame:
    """Rows of wanted types, types in lower case. ``mapping``: ``uniprot_id, foreign_id_type, foreign_id``."""
    kind = F.lower("foreign_id_type")
    return mapping.filter(kind.isin([t.lower() for t in types])).withColumn("foreign_id_type", kind)


def structure_hits(hits: DataFrame) -> DataFrame:
    """``accession, structure, evalue`` of hits against structures: ``x|ACC|y`` and ``ID_chain`` ids, best e-value each."""
    q = F.coalesce(F.nullif(F.regexp_extract("qseqid", r"\|([^|]+)\|", 1), F.lit("")), "qseqid")
    s = F.upper(F.regexp_extract("sseqid", r"(?:pdb\|)?([A-Za-z0-9]{4})", 1))
    return hits.select(q.alias("accession"), s.alias("structure"), "evalue").groupBy("accession").agg(F.min(F.struct("evalue", "structure")).alias("x")).select("accession", "x.structure", "x.evalue")
