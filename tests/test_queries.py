"""Registered queries against their SQL on the smallest tables.

By default a few queries of every module run; ALL_QUERIES=1 runs them all.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from oracle_queries.registry import TABLES

SMALL = "/root/testdata/sf0.001"
FEW = [
    "gene_scores", "query_weight", "subject_coverage", "interval_islands", "apply_id_mapping", "unaligned_reads",
    "renormalise", "regroup_mean", "join_tables", "relative_expression_witten_bell", "unpack_pathways", "profile_order",
    "gap_fill", "structured_pathway_score", "flat_pathway_abundance", "unmapped_unintegrated", "uncovered_reactions",
    "lineage", "infer_taxonomy_totals", "spearman", "kruskal_wallis", "bh_qvalues", "top_taxa", "braycurtis",
    "translate_frames", "read_feature_table", "profile_gene_families", "contribution_table",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else FEW)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.collect(), df.columns) == rows_of(cursor.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
