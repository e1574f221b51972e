"""Registered queries against their SQL, and the package's borders."""

import math
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
CHECKED = ["s5_replace_slice", "n8_split_registry", "d2_daily_rollup", "p2_segment_profile", "b3_extents", "c2_daily_metrics", "e9_events", "k2_ranked_dashboard", "k6_region_hourly", "k15_intersection_index", "i11_grouped", "g2_districts", "k18_severity_classes", "i15_display_tiers", "s7_upsert", "s11_topology_document", "s13_refreshed_daily", "s10_geojson_document"]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, bool):
            return v
        return round(float(v), 9) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "if" else str(v).removesuffix(" 00:00:00")

    return sorted((tuple(map(one, row)) for row in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(name, spark, tables):
    got, want = entry.queries()[name](spark, SF).toPandas(), tables.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert plain(got) == plain(want)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 90


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_the_rest_never_imports_the_corpus_operators():
    code = "import sys, roadloom.plans.queries, roadloom.plans.warehouse, roadloom.streaming.ingest; assert not [m for m in sys.modules if m.startswith('roadloom.llm')]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
