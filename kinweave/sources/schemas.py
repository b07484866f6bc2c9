"""Fixed schemas of files; column names and order are those of the formats."""

from pyspark.sql import types as T

HITS = "qseqid string, sseqid string, pident float, alignment_length int, mismatches int, gap_openings int, qstart int, qend int, sstart int, send int, evalue float, bitscore float"
HIT_COLUMNS = ["qseqid", "sseqid", "pident", "alignment_length", "bitscore"]
EDGES = "qseqid string, sseqid string, pident float, alignment_length int, bitscore float, query_length int, subject_length int, alignment_score int"
METADATA = "UniProt_ID string, Attribute string, Value string"

_ATT = T.StructType([T.StructField(f"_{n}", T.StringType()) for n in ("name", "type", "value")])
_LIST_ATT = T.StructType([*_ATT.fields, T.StructField("att", T.ArrayType(_ATT))])
NODE = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_label", T.StringType()), T.StructField("att", T.ArrayType(_LIST_ATT))])
EDGE = T.StructType([*[T.StructField(f"_{n}", T.StringType()) for n in ("id", "label", "source", "target")], T.StructField("att", T.ArrayType(_ATT))])
