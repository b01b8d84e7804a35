"""Builds on tables in which a variant comes at several sites, as it does once the tables are large."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from test_queries import SF_DIR, compare, duck_connection

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

# Sites this far apart have one contig, position and, for most, alleles.
SHIFT = 5_400_000


@pytest.fixture(scope="module")
def repeated_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("repeated")
    for table, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("part", None), ("supplier", None)):
        source = f"'{SF_DIR}/{table}.parquet'"
        rows = f"SELECT * FROM {source}"
        if key is not None:
            rows = f"SELECT * REPLACE ({key} + copy * {SHIFT} AS {key}) FROM {source}, (SELECT unnest(range(2)) AS copy)"
        duckdb.sql(f"COPY ({rows}) TO '{root}/{table}.parquet' (FORMAT parquet)")
    return str(root)


@pytest.mark.parametrize("name", ["pre_deleteriousness", "feature_table", "run_pipeline", "incremental_features"])
def test_repeated_score_rows_give_repeated_rows(spark, repeated_dir, name):
    same, text = compare(spark, duck_connection(repeated_dir), repeated_dir, name)
    assert same, text
    rows = int(text.split()[0])
    assert rows > duck_connection(SF_DIR).execute(f"SELECT count(*) FROM ({spark_entry.oracle_sql()[name]})").fetchone()[0]
