"""Queries whose whole result SQL can express, against DuckDB on the smallest tables."""

import os

import pytest

from quillstone.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["op6_benchmark_decontamination", "op9_suffix_dedup", "op10_minhash_near_dedup", "op11_line_dedup", "op12_spelling_variants", "op13_centroid_clustering"])
def test_rows_equal_the_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = registry.queries()[name](spark, SF)
    columns = ", ".join(sorted(found.columns))
    want = con.execute(f"SELECT {columns} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, found.select(*sorted(found.columns)).collect()), key=repr) == sorted(want, key=repr) and want
