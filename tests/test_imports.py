from pyspark.sql import functions as F

from kinweave.operators import annotations as A
from kinweave.operators import imports as I
from kinweave.sources import readers as R
from kinweave.sources import writers as W


def test_ids(spark, rows):
    ids = ["123", "ABC12345", "NP_1.1", "P12345", "1abc", "?!"]
    df = spark.createDataFrame([(i,) for i in ids], "id string").select("id", I.classify_id(F.col("id")).alias("k"))
    assert dict(rows(df)) == {"123": "gi", "ABC12345": "genbank", "NP_1.1": "ncbi", "P12345": "uniprot", "1abc": "pdb", "?!": "unknown"}
    mapping = spark.createDataFrame([("Q2", "gi", "123"), ("Q1", "gi", "123")], "uniprot_id string, foreign_id_type string, foreign_id string")
    got = I.reverse_lookup(spark.createDataFrame([("sp|P12345.2|X",), ("123",), ("?!",)], "id string"), mapping)
    assert rows(got.select("id", "uniprot_id", "matched")) == [("123", "Q1", True), ("?!", None, False), ("P12345.2", "P12345", True)]


def test_domains(spark, rows):
    dom = spark.createDataFrame([("A", 1, 10, 50), ("A", 20, 50, 50)], "accession string, start int, end int, full_length int")
    assert rows(I.domain_regions(dom, "n")) == [("A", 11, 19)]
    assert rows(I.domain_regions(dom, "c")) == [("A", 11, 19)]
    seqs = spark.createDataFrame([("A", "ABCDEFGHIJ")], "accession string, sequence string")
    cut = spark.createDataFrame([("A", 3, 5), ("A", None, None)], "accession string, start int, end int")
    assert rows(I.extract_domains(cut, seqs)) == [("A:1:10", "ABCDEFGHIJ", 10), ("A:3:5", "CDE", 3)]


def test_taxonomy_presets(spark, rows):
    tax = spark.createDataFrame([(1, "Eukaryota", "Ascomycota", "x"), (2, "Eukaryota", "Chordata", "y"), (3, "Eukaryota", "Chordata", "metagenome"), (4, "Bacteria", None, "z"), (5, None, None, None)], "taxonomy_id int, domain string, phylum string, species string")
    ids = tax.select("taxonomy_id")
    of = lambda n: [r.taxonomy_id for r in I.filter_taxonomy_preset(ids, tax, n).orderBy("taxonomy_id").collect()]
    assert [of(n) for n in ("fungi", "bacteria_fungi", "eukaryota_no_fungi", "bacteria", "nothing")] == [[1], [1, 4], [2], [4], []]


def test_merge(spark, rows):
    family, user = spark.createDataFrame([("S",), ("T",)], "id string"), spark.createDataFrame([("S",), ("u",), ("m",)], "id string")
    seeds = spark.createDataFrame([("m", "T")], "accession string, seed string")
    assert rows(I.merge_metadata(family, user, seeds)) == [("S", "FAMILY+USER", ["S"]), ("T", "FAMILY+USER", ["m"]), ("u", "USER", ["u"])]


def test_fasta_files(spark, rows, tmp_path):
    (tmp_path / "a.fa").write_text(">one desc\r\nMK\r\nTA\r\n>two\n\n>three x|y\nGG\n")
    got = R.read_fasta(spark, str(tmp_path / "a.fa"))
    assert rows(got.select("seq_id", "header", "sequence", "length")) == [("one", "one desc", "MKTA", 4), ("three", "three x|y", "GG", 2), ("two", "two", "", 0)]
    W.write_fasta(got.filter("length > 0"), str(tmp_path / "b"), fold=3)
    assert rows(R.read_fasta(spark, str(tmp_path / "b")).select("seq_id", "sequence")) == [("one", "MKTA"), ("three", "GG")]


def test_network_files(spark, rows, tmp_path):
    att = "array<struct<name:string,type:string,values:array<string>>>"
    nodes = spark.createDataFrame([("a", 'l<"&>', [("n", "integer", ["3"]), ("t", "list", ["x", "y\x01"])])], f"id string, label string, attributes {att}")
    edges = spark.createDataFrame([("a", "b", [("s", "real", ["1.5"])])], f"source string, target string, attributes {att}")
    W.write_network(nodes, edges, str(tmp_path / "net"))
    n, e = R.read_network(spark, str(tmp_path / "net"))
    assert rows(n.select("id", "label")) == [("a", 'l<"&>')]
    assert {x.name: x["values"] for x in n.first().attributes} == {"n": ["3"], "t": ["x", "y"]}
    assert rows(e.select("source", "target")) == [("a", "b")]


def test_node_table(spark, rows):
    meta = spark.createDataFrame([("A", "Org", "None^b,a^b"), ("A", "Sequence_Length", "100"), ("A", "X", "None")], "id string, attribute string, value string")
    got = A.node_table(spark.createDataFrame([("A:11:20",), ("A",)], "node string"), meta)
    assert rows(got) == [("A", "Org", ["a", "b"]), ("A", "Sequence_Length", ["100"]), ("A", "X", ["None"]), ("A:11:20", "Org", ["a", "b"]), ("A:11:20", "Sequence_Length", ["10"]), ("A:11:20", "X", ["None"])]
