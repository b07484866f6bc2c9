"""Files and tables as they are written, and lookups with nulls, ties and repeats."""

import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from kinweave.operators import annotations as A
from kinweave.operators import clusters as C
from kinweave.operators import imports as I
from kinweave.operators import tables as T
from kinweave.sources import readers as R
from kinweave.sources import writers as W

ATT = "array<struct<name:string,type:string,values:array<string>>>"


def test_network_parts_join_to_one_document(spark, rows, tmp_path):
    nodes = spark.range(50).repartition(4).select(F.concat(F.lit("n<"), "id").alias("id"), F.when(F.col("id") > 3, "l&").alias("label"), F.when(F.col("id") % 2 == 0, F.array(F.struct(F.lit("k").alias("name"), F.lit("string").alias("type"), F.array(F.lit('"v"')).alias("values")))).alias("attributes"))
    edges = spark.range(40).repartition(3).select(F.concat(F.lit("n<"), "id").alias("source"), F.concat(F.lit("n<"), F.col("id") + 1).alias("target"), F.array().cast(ATT).alias("attributes"))
    path = str(tmp_path / "net")
    W.write_network(nodes, edges, path, 'a "name"')
    files = [r.value for r in spark.read.text(f"{path}/manifest").coalesce(1).collect()]
    assert [f.split("/")[0][0] for f in files] == sorted(f[0] for f in files) and len(files) >= 7
    graph = ET.fromstring("".join(open(f"{path}/{f}").read() for f in files).split("?>", 1)[1])
    tags = [x.tag.rpartition("}")[2] for x in graph]
    assert tags == ["node"] * 50 + ["edge"] * 40 and graph.get("label") == 'a "name"'
    n, e = R.read_network(spark, path)
    assert (n.count(), e.count()) == (50, 40)
    assert rows(n.filter("id = 'n<4'").select("id", "label")) == [("n<4", "l&")] and n.filter("id = 'n<1'").first().label == "n<1"
    whole = tmp_path / "whole.xml"
    whole.write_text("".join(open(f"{path}/{f}").read() for f in files))
    n, e = R.read_network(spark, str(whole))
    assert (n.count(), e.count()) == (50, 40)
    W.write_network(nodes.limit(0), edges.limit(0), str(tmp_path / "none"))
    assert R.read_network(spark, str(tmp_path / "none"))[0].count() == 0


def test_tables_of_a_database(spark, rows, tmp_path):
    url, options = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i if i % 10 else None, f"s{i}") for i in range(1, 101)], "num int, name string")
    for name, part in (("many", df), ("single", df.filter("num = 5")), ("empty", df.limit(0)), ("blank", df.filter("num IS NULL"))):
        part.write.jdbc(url, name, properties=options | {"createTableColumnTypes": "name VARCHAR(20)"})
    got = R.read_reference_tables(spark, url, ["many", "single", "empty", "blank"], {n: "num" for n in ("many", "single", "empty", "blank")}, parts=4, **options)
    low = lambda t: rows(t.toDF("num", "name"))
    assert low(got["many"]) == rows(df) and got["many"].rdd.getNumPartitions() == 4
    assert low(got["single"]) == [(5, "s5")] and got["empty"].count() == 0 and got["blank"].count() == 10
    assert low(R.read_reference_tables(spark, url, ["many"], **options)["many"]) == rows(df)


def test_metadata_keeps_odd_values(spark, rows, tmp_path):
    values = ["a#b", "#c", 'q"x"', "back\\slash", "comma, ^", " lead", "tail "]
    wide = spark.createDataFrame([(f"id{i}", v, None) for i, v in enumerate(values)], "id string, A string, B string")
    W.write_metadata(wide, str(tmp_path / "m"))
    assert sorted(r.value.strip() for r in R.read_metadata(spark, str(tmp_path / "m")).collect()) == sorted(v.strip() for v in values)


def test_fasta_numbers_are_never_cut(spark, rows):
    records = spark.createDataFrame([(1, "x", "MK"), (2, "y", "MA"), (3, "sp|P11111|a", "M"), (4, "P11111", "MM"), (5, "z", ""), (6, None, "MQ"), (7, "w", None)], "seq_no long, header string, sequence string")
    known = spark.createDataFrame([("P11111",)], "id string")
    ids = lambda first: [r.id for r in I.import_fasta(records, known, first=first).orderBy("seq_no").collect()]
    assert ids(1) == ["ZZZZZZ1", "ZZZZZZ2", "P11111", "ZZZZZZ5"]
    assert ids(9_999_999) == ["9999999", "10000000", "P11111", "10000003"]
    assert ids(1_000_000_000) == ["1000000000", "1000000001", "P11111", "1000000004"]
    assert I.import_fasta(records.limit(0), known).count() == 0


def test_seed_members_by_accession(spark, rows):
    seeds = spark.createDataFrame([("S", "S", "S"), ("a", "S", "S"), ("b", "S", "T"), ("T", "S", "T"), ("n", None, None)], "accession string, seed50 string, seed90 string")
    got = rows(I.seed_members(spark.createDataFrame([("S",), ("b",), ("T",), ("n",), ("?",), (None,), ("b",)], "id string"), seeds))
    all_ = ["S", "T", "a", "b"]
    assert got == [("?", [], [], []), ("S", all_, ["S", "a"], ["S", "T"]), ("T", all_, ["T", "b"], ["S", "T"]), ("b", all_, ["T", "b"], ["S", "T"]), ("n", [], [], [])]


def test_painting_does_not_depend_on_order(spark, rows):
    nodes = spark.createDataFrame([("a",), ("b",), (None,)], "node string")
    mapping = spark.createDataFrame([("a", "#2", "x"), ("a", "#1", "y"), ("a", "#1", "w"), (None, "#9", "z")], "id string, color string, kind string")
    assert rows(C.paint_nodes(nodes, mapping, extra={"kind": 2})) == [("a", "#1", "w"), ("b", None, None), (None, None, None)]


def test_taxa_that_come_twice(spark, rows):
    taxon = "struct<_taxId:int,_scientificName:string,_rank:string>"
    schema = f"_taxId int, _scientificName string, _rank string, lineage struct<taxon:array<{taxon}>>, children struct<taxon:array<{taxon}>>"
    data = [(1, "G", "genus", ([(9, "F", "family")],), ([(2, "child name", None)],)), (2, "own name", "species", None, None), (2, "later name", "species", None, None), (None, "x", "species", None, None)]
    got = {r.taxonomy_id: (r.family, r.genus, r.species) for r in T.parse_taxonomy(spark.createDataFrame(data, schema)).collect()}
    assert got == {1: ("F", "G", "NA"), 2: ("NA", "NA", "later name")}
    assert T.parse_taxonomy(spark.createDataFrame([], schema)).count() == 0


def test_id_mapping_and_structures(spark, rows):
    mapping = spark.createDataFrame([("A", "GI", "1"), ("B", "pdb", "2"), ("C", None, "3"), ("A", "GI", "1")], "uniprot_id string, foreign_id_type string, foreign_id string")
    assert rows(T.filter_id_mapping(mapping, ["gi"])) == [("A", "gi", "1")] * 2
    assert T.filter_id_mapping(mapping.limit(0), ["gi"]).count() == 0
    hits = spark.createDataFrame([("sp|Q1|x", "1abc_A", 1e-5), ("Q1", "2xyz_B", 1e-5), ("Q1", "3xyz", 1.0)], "qseqid string, sseqid string, evalue double")
    assert rows(T.structure_hits(hits)) == [("Q1", "1ABC", 1e-5)]


def test_annotations_of_odd_rows(spark, rows):
    acc = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "accession string")
    notes = spark.createDataFrame([("A", 1), ("B", None)], "accession string, taxonomy_id int")
    tax = spark.createDataFrame([(1, "sp")], "taxonomy_id int, species string")
    fams = spark.createDataFrame([("A", "F2"), ("A", "F1"), ("A", "F2")], "accession string, family string")
    ipro = spark.createDataFrame([("A", "I1", "domain"), ("A", "I1", "domain")], "accession string, family string, family_type string")
    got = A.annotate(acc, notes, tax, fams, ipro).select("accession", "species", "families", "interpro_ids", "interpro_types")
    assert rows(got) == [("A", "sp", ["F1", "F2"], ["I1"], ["domain"]), ("B", None, [], [], [])]
    shown = spark.createDataFrame([("A", True, "Name; ", True, None, ""), ("B", None, None, None, True, None)], "accession string, is_reviewed boolean, description string, is_fragment boolean, gdna boolean, organism string")
    assert rows(A.format_annotations(shown, ["organism"])) == [("A", "SwissProt", "Name", "fragment", "False", "None"), ("B", "TrEMBL", "NA", "complete", "True", "None")]
    kinds = spark.createDataFrame([("A", "I1", "Domain"), ("A", "I2", None), ("A", "I3", "Repeat"), ("A", "I3", "Repeat")], "accession string, family string, family_type string")
    assert rows(A.split_family_types(kinds)) == [("A", ["I1"], [], [], ["I2", "I3"])]
    docs = spark.createDataFrame([("A", '{"d": "x"}'), ("B", " "), ("C", None)], "accession string, metadata string")
    assert rows(A.decode_metadata(docs, {"d": "description"})) == [("A", "x"), ("B", None), ("C", None)]


def test_members_and_foreign_ids(spark, rows):
    members = spark.createDataFrame([("S", "a"), ("S", "S"), ("S", "b")], "seed string, accession string")
    values = spark.createDataFrame([("a", "x; "), ("S", None), ("b", "z")], "accession string, organism string")
    assert rows(A.merge_member_rows(members, values, ["organism"])) == [("S", "^x^z")]
    lengths = spark.createDataFrame([("S", 7)], "seqid string, sequence_length long")
    assert rows(A.seed_attributes(members, lengths)) == [("S", "S,a,b", 3, 7)]
    mapping = spark.createDataFrame([("A", "ncbi", "N1"), ("A", "genbank", "G1"), ("A", "gi", "1"), ("A", None, "2")], "uniprot_id string, foreign_id_type string, foreign_id string")
    ids = spark.createDataFrame([("A",), ("B",), ("A",)], "id string")
    assert rows(A.foreign_ids(ids, mapping)) == [("A", "GENBANK:G1,NCBI:N1"), ("B", "")]


@pytest.mark.parametrize("repeat", [1, 3])
def test_rep_nodes_of_repeated_rows(spark, rows, repeat):
    clusters = spark.createDataFrame([("R", "R"), ("R", "m"), ("Q", "Q")] * repeat, "representative string, member string")
    attributes = spark.createDataFrame([("R", "Org", "x"), ("m", "Org", "None"), ("m", "Org", "y"), ("Q", "Org", "")] * repeat, "id string, attribute string, value string")
    edges = spark.createDataFrame([("R", "Q", 1.0), ("R", "m", 2.0), (None, "Q", 3.0)], "qseqid string, sseqid string, bitscore double")
    nodes, kept = A.repnode_network(clusters, attributes, edges)
    assert rows(nodes) == [("Q", "Org", ["None"], 1), ("R", "Org", ["x", "y"], 2)]
    assert rows(kept) == [("R", "Q", 1.0)]


@pytest.mark.parametrize("size", [1, 3, 100])
def test_chunks_join_to_the_whole(spark, size):
    members = spark.createDataFrame([(s, f"{s}{i:03d}") for s, n in (("S", 40), ("T", 1), ("U", 7)) for i in range(n)] + [(s, s) for s in "STU"], "seed string, accession string")
    whole = {r.seed: r.members for r in I.collapse_to_seeds(members.union(members), "seed").collect()}
    parts = I.collapse_to_seeds(members.union(members), "seed", chunk=size).orderBy("seed", "chunk").collect()
    joined = {}
    for r in parts:
        assert 0 < len(r.members) == r.member_count <= size and r.chunk == sum(x.seed == r.seed and x.chunk < r.chunk for x in parts)
        joined[r.seed] = joined.get(r.seed, []) + r.members
    assert joined == whole
    alive = members.filter("accession LIKE '%1'").select("accession")
    again = I.refilter_member_lists(spark.createDataFrame([(r.seed, r.members) for r in parts], "id string, members array<string>"), alive, chunk=size)
    assert sorted(m for r in again.collect() for m in r.members) == sorted(r.accession for r in alive.collect())
    values = members.withColumn("v", F.concat("accession", F.lit("; "))).select("accession", "v")
    text = {r.seed: r.v for r in A.merge_member_rows(members, values, ["v"]).collect()}
    pieces = A.merge_member_rows(members, values, ["v"], chunk=size).orderBy("seed", "chunk").collect()
    assert {s: "^".join(r.v for r in pieces if r.seed == s) for s in text} == text
    attributes = values.select(F.col("accession").alias("id"), F.lit("a").alias("attribute"), F.when(F.col("accession").startswith("S"), F.col("v")).alias("value"))
    edges = spark.createDataFrame([], "qseqid string, sseqid string")
    nodes = A.repnode_network(members.toDF("representative", "member"), attributes, edges, chunk=size)[0].collect()
    assert sum(len(r["values"]) for r in nodes) == 41 + 2 and all(len(r["values"]) <= max(size, 1) for r in nodes)
    assert {tuple(r["values"]) for r in nodes if r.representative != "S"} == {("None",)}
