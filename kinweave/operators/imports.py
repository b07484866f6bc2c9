"""Import and filtering of id sets: families, accession lists, FASTA headers, hits, taxonomy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.chunks import chunked
from kinweave.functions.ranking import dense_index
from kinweave.functions.staging import Staging

# --- id filters -------------------------------------------------------------------------


def filter_sequences(sequences: DataFrame, min_len: int = 0, max_len: int = 0, ids: DataFrame | None = None, seq_id: str = "seq_id", sequence: str = "sequence") -> DataFrame:
    """Sequences within the bounds (0: no upper bound), of listed ids only; adds ``domain_length``."""
    n = F.length(sequence)
    out = sequences.filter((n >= min_len) & (n <= max_len if max_len else F.lit(True))).withColumn("domain_length", n.cast("long"))
    return out if ids is None else out.join(ids.select(F.col(ids.columns[0]).alias(seq_id)), seq_id, "left_semi")


def filter_fragments(ids: DataFrame, fragments: DataFrame, id: str = "id") -> tuple[DataFrame, DataFrame]:
    """Ids that aren't flagged as fragment, and one row ``removed``; unknown ids stay. ``fragments``: ``id, is_fragment``."""
    flagged = fragments.filter("is_fragment").select(F.col("id").alias(id))
    return ids.join(flagged, id, "left_anti"), ids.join(flagged, id, "left_semi").agg(F.count("*").alias("removed"))


def filter_fraction(ids: DataFrame, frac: float, reviewed: DataFrame, id: str = "id") -> DataFrame:
    """The first ``int(n / frac + 0.5)`` ids in sorted order and all reviewed ids."""
    n = int(ids.count() / frac + 0.5)
    ranked = dense_index(ids, id, name="_i", start=1).join(reviewed.select(F.col(reviewed.columns[0]).alias(id), F.lit(True).alias("_r")).distinct(), id, "left")
    return ranked.filter((F.col("_i") <= n) | F.coalesce("_r", F.lit(False))).drop("_i", "_r")


def sample_every_nth(rows: DataFrame, n: int, family: str = "family", accession: str = "accession", reviewed: str | None = None) -> DataFrame:
    """Every nth row of each family in order of accession, and reviewed rows."""
    number = F.row_number().over(Window.partitionBy(family).orderBy(accession))
    keep = F.col("_i") % n == 0
    return rows.withColumn("_i", number).filter(keep | F.coalesce(F.col(reviewed), F.lit(False)) if reviewed else keep).drop("_i")


def sample_random(rows: DataFrame, fraction: float, seed: int = 0, accession: str = "accession") -> DataFrame:
    """A reproducible share of the rows, by the first 32 bits of the MD5 of ``seed:accession``; null accessions hash as empty."""
    least = "%08x" % min(int(fraction * (1 << 32)), (1 << 32) - 1)
    return rows.filter(F.substr(F.md5(F.concat_ws(":", F.lit(str(seed)), accession)), F.lit(1), F.lit(8)) < least)


#: Names of ranks that differ from their columns.
RANK_ALIASES = {"superkingdom": "domain", "order": "tax_order"}


def taxonomy_condition(spec: str) -> Column:
    """OR of ``rank LIKE %pattern%`` from ``rank:pattern;rank:pattern``."""
    parts = [p.split(":", 1) for p in spec.split(";") if ":" in p]
    tests = [F.coalesce(F.col(RANK_ALIASES.get(r.strip().lower(), r.strip().lower())).contains(v.strip()), F.lit(False)) for r, v in parts]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def filter_taxonomy(ids: DataFrame, taxonomy: DataFrame, spec: str, tax_id: str = "taxonomy_id") -> DataFrame:
    """Ids whose taxon fits the condition; ``ids`` and ``taxonomy`` share the column ``tax_id``."""
    return ids.join(taxonomy.filter(taxonomy_condition(spec)).select(tax_id), tax_id, "left_semi").select(ids.columns)


#: Phyla that the presets call fungi.
FUNGI = ("Ascomycota", "Basidiomycota", "Fungi incertae sedis", "unclassified fungi")


def taxonomy_preset(name: str) -> Column:
    """Condition of a named preset; matching ignores case, a missing rank fits nothing."""
    holds = lambda c, *v: reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).contains(x.lower()), F.lit(False)) for x in v])
    fungi = holds("phylum", *FUNGI)
    presets = {
        "bacteria_fungi": holds("domain", "bacteria", "archaea") | fungi,
        "fungi": fungi,
        "eukaryota_no_fungi": (F.lower("domain") == "eukaryota") & F.col("phylum").isNotNull() & ~fungi & ~holds("species", "metagenome"),
        "viruses": holds("domain", "viruses"),
        "bacteria": holds("domain", "bacteria"),
        "archaea": holds("domain", "archaea"),
        "eukaryota": holds("domain", "eukaryota"),
    }
    return presets.get(name, F.lit(False))


def filter_taxonomy_preset(ids: DataFrame, taxonomy: DataFrame, name: str, tax_id: str = "taxonomy_id") -> DataFrame:
    """Ids whose taxon fits a named preset; ids without a known taxon go."""
    return ids.join(taxonomy.filter(taxonomy_preset(name)).select(tax_id), tax_id, "left_semi").select(ids.columns)


def filter_family_membership(ids: DataFrame, members: DataFrame, families: list[str], id: str = "id") -> DataFrame:
    """Ids that belong to any listed family. ``members``: ``family, accession``."""
    return ids.join(members.filter(F.col("family").isin(families)).select(F.col("accession").alias(id)), id, "left_semi")


def _members_of(rows: DataFrame, key: str, chunk: int | None) -> DataFrame:
    """``key, members`` of ``key, m``: distinct and sorted, whole or in chunks."""
    some = rows.filter(F.col("m").isNotNull())
    if chunk:
        return chunked(some.distinct(), [key], ["m"], F.col("m"), chunk, "members")
    return some.groupBy(key).agg(F.array_sort(F.collect_set("m")).alias("members"))


def exclude_ids(members: DataFrame, fragments: DataFrame | None = None, taxonomy: DataFrame | None = None, spec: str = "", family_members_: DataFrame | None = None, families: list[str] = (), chunk: int | None = None) -> DataFrame:
    """``seed, members``: seeds that pass all filters with their passing members.

    ``members``: ``seed, accession, taxonomy_id``; a seed is itself one of its members. With
    ``chunk``, a seed has rows ``seed, chunk, members`` of up to so many members each.
    """
    ok = members
    if fragments is not None:
        ok = filter_fragments(ok, fragments, "accession")[0] if "accession" in ok.columns else ok
    if taxonomy is not None:
        ok = filter_taxonomy(ok, taxonomy, spec)
    if family_members_ is not None:
        ok = filter_family_membership(ok, family_members_, families, "accession")
    seeds = ok.filter("accession = seed").select("seed").distinct()
    return _members_of(ok.join(seeds, "seed", "left_semi").select("seed", F.col("accession").alias("m")), "seed", chunk)


def refilter_member_lists(metadata: DataFrame, survivors: DataFrame, chunk: int | None = None) -> DataFrame:
    """Trims each ``members`` list to surviving ids; seeds without any go. ``metadata``: ``id, members``.

    An id may have several rows, as chunks of a list are; with ``chunk`` the result has such rows too.
    """
    alive = survivors.select(F.col(survivors.columns[0]).alias("m"))
    return _members_of(metadata.select("id", F.explode("members").alias("m")).join(alive, "m", "left_semi").select("id", "m"), "id", chunk)


def drop_represented_nodes(metadata: DataFrame, members: DataFrame) -> DataFrame:
    """Metadata of ids other than non-representative members. ``members``: ``representative, member``."""
    return metadata.join(members.filter("member != representative").select(F.col("member").alias("id")), "id", "left_anti")


# --- families ---------------------------------------------------------------------------


def route_families(names: DataFrame) -> DataFrame:
    """``family, source`` of a column of comma lists: PF, IPR or CL ids in upper case; others go."""
    one = names.select(F.explode(F.split(F.upper(names.columns[0]), r"\s*,\s*")).alias("family")).withColumn("family", F.trim("family"))
    source = F.when(F.col("family").startswith("PF"), "pfam").when(F.col("family").startswith("IPR"), "interpro").when(F.col("family").startswith("CL"), "clan")
    return one.withColumn("source", source).filter("source IS NOT NULL").distinct()


def expand_clans(families: DataFrame, clans: DataFrame) -> DataFrame:
    """Family ids with clans replaced by their families. ``families``: ``family``; ``clans``: ``family, clan``."""
    own = families.join(clans.select(F.col("clan").alias("family")).distinct(), "family", "left_anti").select("family")
    return own.unionByName(families.join(clans.withColumnRenamed("family", "_f"), families["family"] == F.col("clan")).select(F.col("_f").alias("family"))).distinct()


def family_members(families: DataFrame, members: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Members of families with domain bounds and seeds; an isoform suffix ``-N`` goes. ``members``: ``family, accession, start, end``."""
    rows = members.join(families.select("family").distinct(), "family", "left_semi").withColumn("accession", F.regexp_replace("accession", r"-\d+$", ""))
    return rows if seeds is None else rows.join(seeds, "accession", "left")


def collapse_to_seeds(rows: DataFrame, seed: str = "seed50", accession: str = "accession", chunk: int | None = None) -> DataFrame:
    """``seed, members, member_count`` of seeds that are among the rows themselves.

    With ``chunk``, a seed has rows ``seed, chunk, members, member_count`` of up to so many
    members each; the count is that of the row.
    """
    own = rows.filter(F.col(accession) == F.col(seed)).select(seed).distinct()
    lists = _members_of(rows.join(own, seed, "left_semi").select(F.col(seed).alias("seed"), F.col(accession).alias("m")), "seed", chunk)
    return lists.withColumn("member_count", F.size("members").cast("long"))


def full_family_count(members: DataFrame, families: list[str], clans: DataFrame | None = None) -> DataFrame:
    """``name, total, unique`` for each family, each clan and all of them together."""
    rows = members.filter(F.col("family").isin(families))
    sets = [rows.select(F.col("family").alias("name"), "accession"), rows.select(F.lit("all").alias("name"), "accession")]
    if clans is not None:
        sets.append(rows.join(clans, "family").select(F.col("clan").alias("name"), "accession"))
    return reduce(DataFrame.unionByName, sets).groupBy("name").agg(F.count("*").alias("total"), F.countDistinct("accession").alias("unique"))


def filter_family_length(rows: DataFrame, lengths: DataFrame, min_len: int = 0, max_len: int = 0, accession: str = "accession") -> DataFrame:
    """Family rows whose sequence length is within the bounds. ``lengths``: ``seqid, sequence_length``."""
    n = F.col("sequence_length")
    fits = lengths.filter((n >= min_len) & (n <= max_len if max_len else F.lit(True))).select(F.col("seqid").alias(accession))
    return rows.join(fits, accession, "left_semi")


def domain_regions(domains: DataFrame, side: str, accession: str = "accession", full_length: str = "full_length") -> DataFrame:
    """The region before (``n``) or after (``c``) each domain, up to the neighbouring domain or the end of the sequence."""
    w = Window.partitionBy(accession).orderBy("start", "end")
    if side == "n":
        a, b = F.coalesce(F.lag("end").over(w), F.lit(0)) + 1, F.col("start") - 1
    else:
        a, b = F.col("end") + 1, F.coalesce(F.lead("start").over(w) - 1, F.col(full_length))
    return domains.select(accession, a.cast("long").alias("region_start"), b.cast("long").alias("region_end")).filter("region_end >= region_start")


# --- ids --------------------------------------------------------------------------------


#: Kinds of ids and their patterns; the first that fits decides.
ID_KINDS = (
    ("gi", r"^\d+$"),
    ("genbank", r"^[A-Za-z]{3}\d{5}(\.\d+)?$"),
    ("ncbi", r"^[A-Za-z]{2}_\d+(\.\d+)?$"),
    ("uniprot", r"^[A-Za-z]\d[A-Za-z0-9]{3,8}(\.\d+)?$"),
    ("pdb", r"^[A-Za-z0-9]{4}$"),
)


def classify_id(id: Column) -> Column:
    """Kind of an id by the first pattern that fits, ``unknown`` if none does or the id is null."""
    out = F.lit("unknown")
    for name, pattern in reversed(ID_KINDS):
        out = F.when(id.rlike(pattern), name).otherwise(out)
    return out


def clean_id(id: Column) -> Column:
    """The id of ``xx|ID|yy`` or ``ID|yy``, else the id."""
    parts = F.split(F.trim(id), r"\|")
    return F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).when(F.size(parts) == 2, F.when(F.length(F.get(parts, F.lit(0))) <= 2, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0)))).otherwise(F.get(parts, F.lit(0)))


def reverse_lookup(ids: DataFrame, mapping: DataFrame, native: str = "uniprot") -> DataFrame:
    """``id, kind, uniprot_id, matched`` for each distinct id.

    Native ids pass with their version removed; the others take the smallest mapped id of
    their (type, id). ``mapping``: ``uniprot_id, foreign_id_type, foreign_id``.
    """
    one = ids.select(clean_id(F.col(ids.columns[0])).alias("id")).filter("id != ''").distinct().withColumn("kind", classify_id(F.col("id")))
    table = mapping.groupBy(F.col("foreign_id_type").alias("kind"), F.col("foreign_id").alias("id")).agg(F.min("uniprot_id").alias("mapped"))
    found = F.when(F.col("kind") == native, F.regexp_replace("id", r"\.\d+$", "")).otherwise(F.col("mapped"))
    return one.join(table, ["kind", "id"], "left").select("id", "kind", found.alias("uniprot_id"), found.isNotNull().alias("matched"))


def reverse_map(looked_up: DataFrame) -> DataFrame:
    """``uniprot_id, ids``: the given ids behind each matched one."""
    return looked_up.filter("matched").groupBy("uniprot_id").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def import_accessions(ids: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata rows and one row of counts of a free id list."""
    looked = reverse_lookup(ids, mapping)
    counts = looked.agg(F.count("*").alias("num_ids"), F.count_if("matched").alias("num_matched"), F.count_if(~F.col("matched")).alias("num_unmatched"), F.count_if(F.col("matched") & (F.col("kind") != "uniprot")).alias("num_foreign"))
    rows = reverse_map(looked).select(F.col("uniprot_id").alias("id"), F.lit("USER").alias("source"), F.col("ids").alias("query_ids"))
    return rows, counts


def parse_fasta_headers(headers: DataFrame, known: DataFrame, id: str = "seq_id", header: str = "header") -> DataFrame:
    """``seq_id, match, others``: the first known native id of a header, and its other candidate ids.

    Candidates are the first words of the parts between ``>`` and ``|`` with five or more characters.
    """
    words = F.transform(F.split(header, r"[>|]"), lambda x: F.regexp_extract(F.trim(x), r"^\S*", 0))
    rows = headers.select(F.col(id).alias("seq_id"), F.posexplode(F.filter(words, lambda x: F.length(x) >= 5)).alias("pos", "word"))
    rows = rows.join(known.select(F.col(known.columns[0]).alias("word"), F.lit(True).alias("is_known")).distinct(), "word", "left")
    first = rows.groupBy("seq_id").agg(F.min(F.when(F.col("is_known"), F.struct("pos", "word"))).alias("m"), F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("all"))
    out = first.select("seq_id", F.col("m.word").alias("match"), F.transform(F.filter("all", lambda x: F.col("m").isNull() | (x["word"] != F.col("m.word"))), lambda x: x["word"]).alias("others"))
    return headers.select(F.col(id).alias("seq_id")).join(out, "seq_id", "left").select("seq_id", "match", F.coalesce("others", F.array().cast("array<string>")).alias("others"))


def import_fasta(records: DataFrame, known: DataFrame, order: str = "seq_no", first: int = 1) -> DataFrame:
    """``id, header, sequence, length, match, description``: matched ids, or a running number padded with Z to seven characters.

    ``records``: ``seq_no`` (file order, unique), ``header, sequence``; empty and null sequences go, and
    so do later records that match the same id. Records without a match all stay; numbers run
    from ``first`` and may be longer than seven characters. A null header has no match. The
    description of a match is cut at 150 characters.
    """
    some = records.filter(F.length(F.coalesce("sequence", F.lit(""))) > 0)
    matched = some.join(parse_fasta_headers(some, known, order).select(F.col("seq_id").alias(order), "match"), order)
    numbered = dense_index(matched, order, name="_i", start=first)
    number = F.col("_i").cast("string")
    id = F.coalesce("match", F.when(F.length(number) < 7, F.lpad(number, 7, "Z")).otherwise(number))
    out = numbered.select(order, id.alias("id"), "header", "sequence", F.length("sequence").cast("long").alias("length"), "match", F.when(F.col("match").isNotNull(), F.substring("header", 1, 150)).otherwise(F.col("header")).alias("description"))
    once = F.row_number().over(Window.partitionBy("id", F.col("match").isNull()).orderBy(order))
    return out.withColumn("_r", once).filter("match IS NULL OR _r = 1").drop("_r")


def import_hits(hits: DataFrame, max_results: int = 0, s: str = "sseqid", order: str = "hit_no") -> DataFrame:
    """``id, first``: distinct subject ids (``x|ID|y``: ID) in order of their first hit."""
    inner = F.regexp_extract(s, r"\|([^|]+)\|", 1)
    out = hits.select(F.when(inner != "", inner).otherwise(F.col(s)).alias("id"), order).groupBy("id").agg(F.min(order).alias("first")).orderBy("first", "id")
    return out.limit(max_results) if max_results else out


def append_query_sequence(metadata: DataFrame, sequence: str, source: str = "INPUT") -> DataFrame:
    """Adds the query sequence under a fixed id. ``metadata``: ``id, sequence_length, source``."""
    row = metadata.sparkSession.createDataFrame([("ZINPUTSEQ", len(sequence), source)], "id string, sequence_length long, source string")
    return metadata.unionByName(row)


#: Ids that one copy of a row of member lists serves.
SERVED = 1000


def seed_members(ids: DataFrame, seeds: DataFrame) -> DataFrame:
    """``id, members50, members90, seeds90``: members under both seed levels and the 90 % seeds under a 50 % seed.

    ``seeds``: ``accession, seed50, seed90``. An id that is a seed of a level stands for itself
    there; one that isn't, but is an accession, stands for the accession's seed of that level (the
    smallest, if it has several rows). Unknown ids get empty lists, null ids go.

    Lists are put together once for each pair of seeds that ids have, and meet the ids last: what
    is moved is a copy of a pair's lists for each ``SERVED`` of its ids, the result's rows are not.
    """
    one = ids.select(F.col(ids.columns[0]).alias("id")).filter("id IS NOT NULL").distinct()
    own = seeds.groupBy(F.col("accession").alias("id")).agg(F.min("seed50").alias("of50"), F.min("seed90").alias("of90"))
    levels = ("50", "90")
    keyed = one.join(own, "id", "left")
    for level in levels:
        is_seed = seeds.select(F.col(f"seed{level}").alias("id")).distinct().withColumn("_is", F.lit(True))
        keyed = keyed.join(is_seed, "id", "left").withColumn(f"key{level}", F.when(F.col("_is"), F.col("id")).otherwise(F.col(f"of{level}"))).drop("_is", f"of{level}")
    keyed = Staging(ids.sparkSession, "members").write(keyed, "keys")
    pairs = keyed.groupBy("key50", "key90").agg(F.ceil(F.count("*") / SERVED).cast("int").alias("_copies"))
    for level in levels:
        lists = [F.array_sort(F.collect_set("accession")).alias(f"members{level}")] + [F.array_sort(F.collect_set("seed90")).alias("seeds90")] * (level == "50")
        pairs = pairs.join(seeds.filter(F.col(f"seed{level}").isNotNull()).groupBy(F.col(f"seed{level}").alias(f"key{level}")).agg(*lists), f"key{level}", "left")
    empty = F.array().cast("array<string>")
    named = lambda c: F.coalesce(c, F.lit("")).alias(f"_{c}")
    # Keys may be null; this tells a missing one from an empty text.
    missing = F.concat(*[F.col(f"key{level}").isNull().cast("string") for level in levels]).alias("_missing")
    sizes = pairs.select("key50", "key90", F.col("_copies").alias("_of"))
    dealt = keyed.join(sizes.select(F.col("key50").alias("_k50"), F.col("key90").alias("_k90"), "_of"), F.col("key50").eqNullSafe(F.col("_k50")) & F.col("key90").eqNullSafe(F.col("_k90")))
    dealt = dealt.select("id", named("key50"), named("key90"), missing, F.pmod(F.xxhash64("id"), F.col("_of")).cast("int").alias("_copy"))
    copies = pairs.select(named("key50"), named("key90"), missing, *[F.coalesce(c, empty).alias(c) for c in ("members50", "members90", "seeds90")], F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
    return dealt.join(copies, ["_key50", "_key90", "_missing", "_copy"]).select("id", "members50", "members90", "seeds90")


def make_metadata(ids: DataFrame, source: str, members: DataFrame | None = None) -> DataFrame:
    """``id, source, members, member_count``; an id without member list is its own member. ``members``: ``id, members``."""
    rows = ids.select(F.col(ids.columns[0]).alias("id")).distinct().withColumn("source", F.lit(source))
    rows = rows.withColumn("members", F.lit(None).cast("array<string>")) if members is None else rows.join(members.select("id", "members"), "id", "left")
    rows = rows.withColumn("members", F.coalesce("members", F.array(F.col("id").cast("string"))))
    return rows.withColumn("member_count", F.size("members").cast("long"))


def merge_metadata(family: DataFrame, user: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """``id, source, user_ids``: FAMILY, USER or FAMILY+USER; user ids inside a family seed belong to the seed.

    ``family``, ``user``: ``id``; ``seeds``: ``accession, seed``.
    """
    mine = user.select("id").distinct()
    if seeds is not None:
        mine = mine.join(seeds.select(F.col("accession").alias("id"), "seed"), "id", "left").join(family.select(F.col("id").alias("seed"), F.lit(True).alias("_in")).distinct(), "seed", "left")
        mine = mine.select(F.when(F.col("_in"), F.col("seed")).otherwise(F.col("id")).alias("key"), "id")
    else:
        mine = mine.select(F.col("id").alias("key"), "id")
    users = mine.groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("user_ids"))
    both = family.select(F.col("id").alias("fid")).distinct().join(users, F.col("fid") == F.col("key"), "full_outer")
    source = F.when(F.col("key").isNull(), "FAMILY").when(F.col("fid").isNull(), "USER").otherwise("FAMILY+USER")
    return both.select(F.coalesce("fid", "key").alias("id"), source.alias("source"), "user_ids")


def import_stats(merged: DataFrame, looked_up: DataFrame) -> DataFrame:
    """One row of totals of a merged import and its id lookup."""
    a = merged.agg(F.count("*").alias("total"), F.count_if(F.col("source").startswith("FAMILY")).alias("family"), F.count_if(F.col("source") == "FAMILY+USER").alias("family_overlap"), F.count_if(F.col("source") == "USER").alias("user"), F.coalesce(F.sum(F.size(F.filter(F.coalesce("user_ids", F.array().cast("array<string>")), lambda x: x != F.col("id")))), F.lit(0)).alias("seed_overlap"))
    b = looked_up.agg(F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched"))
    return a.join(F.broadcast(b))  # one row each


def seed_table(ids: DataFrame, seeds: DataFrame) -> DataFrame:
    """``id, seed90, seed50`` sorted by id; a seed that isn't itself among the ids is empty."""
    one = ids.select(F.col(ids.columns[0]).alias("id")).distinct()
    rows = one.join(seeds.select(F.col("accession").alias("id"), "seed50", "seed90"), "id", "left")
    for c in ("seed90", "seed50"):
        rows = rows.join(one.select(F.col("id").alias(c), F.lit(True).alias(f"_{c}")), c, "left")
    return rows.select("id", *[F.coalesce(F.when(F.col(f"_{c}"), F.col(c).cast("string")), F.lit("")).alias(c) for c in ("seed90", "seed50")]).orderBy("id")


def fetch_sequences(ids: DataFrame, sequences: DataFrame) -> DataFrame:
    """``id, sequence`` of listed ids; a header ``xx|ID|...`` stands for ID. ``sequences``: ``header, sequence``."""
    inner = F.regexp_extract("header", r"^\w+\|([^|\s]+)", 1)
    keyed = sequences.select(F.when(inner != "", inner).otherwise(F.regexp_extract("header", r"^\S+", 0)).alias("id"), "sequence")
    return keyed.join(ids.select(F.col(ids.columns[0]).alias("id")).distinct(), "id", "left_semi")


def extract_domains(domains: DataFrame, sequences: DataFrame, min_len: int = 0, max_len: int = 0) -> DataFrame:
    """``id, sequence, length`` with id ``acc:start:end`` for each domain; missing bounds are the ends of the sequence."""
    both = domains.join(sequences.select("accession", "sequence"), "accession")
    a, b = F.coalesce("start", F.lit(1)).cast("int"), F.coalesce("end", F.length("sequence")).cast("int")
    out = both.select(F.concat_ws(":", "accession", a, b).alias("id"), F.substr("sequence", a, F.greatest(b - a + 1, F.lit(0))).alias("sequence")).withColumn("length", F.length("sequence").cast("long"))
    return out.filter((F.col("length") >= max(min_len, 1)) & (F.col("length") <= max_len if max_len else F.lit(True)))


def ids_by_taxon(annotations: DataFrame, taxa: DataFrame, tax_id: str = "taxonomy_id") -> DataFrame:
    """Accessions of given taxon ids."""
    return annotations.join(taxa.select(F.col(taxa.columns[0]).alias(tax_id)).distinct(), tax_id, "left_semi").select("accession", tax_id)


def compare_id_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """``id, where`` (both, left, right) of two id lists."""
    a = left.select(F.col(left.columns[0]).alias("id")).distinct().withColumn("_l", F.lit(True))
    b = right.select(F.col(right.columns[0]).alias("id")).distinct().withColumn("_r", F.lit(True))
    where = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right")
    return a.join(b, "id", "full_outer").select("id", where.alias("where"))
