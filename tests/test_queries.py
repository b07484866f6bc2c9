"""A few registered queries against their SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
NAMES = ["score_statistics", "top_hits_per_query", "demultiplex", "taxonomy_tree", "merge_metadata", "cooccurrence", "read_network", "parse_taxonomy", "connectivity_colors", "sample_random", "taxonomy_tree_additive", "family_hierarchy", "family_arrangements", "parse_protein_records", "annotate", "connected_components"]
NAMES += ["seed_members", "import_fasta", "write_fasta", "write_metadata", "read_metadata", "query_status", "singletons", "number_clusters", "cluster_info", "component_sizes", "cluster_colors", "color_network", "connected_components_many"]
NAMES += ["collapse_to_seeds_chunks", "merge_member_rows_chunks", "all_by_all_similarity_floor", "exclude_ids", "refilter_member_lists", "repnode_network", "paint_nodes", "blast_hit_table", "family_sizes", "index_nodes", "write_network", "neighbor_details_above_threshold"]


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, DIR).toPandas()
    assert sorted(got.columns) == sorted(want.columns)

    def cells(v):
        if hasattr(v, "__len__") and not isinstance(v, str):
            return str(list(v))
        if v is None or v is pd.NA or v != v:
            return ""
        return v if isinstance(v, str) else f"{float(v):.6g}"

    table = lambda df: sorted(tuple(cells(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))
    assert table(got) == table(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
