"""The driver's contract, and a part of the registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

import check_oracle
from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from tripflow.catalog import load_all

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# A cross-section; check_oracle.py runs all of them.
COMPARED = [
    "describe_columns_o69",
    "fact_insert_o08",
    "metric_rollup_o62",
    "orphan_keys_o49",
    "planted_leak_o103",
    "reject_reasons_o32",
    "trace_figure_o110",
]
needs_tables = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="no sample tables here")


def test_every_catalog_query_has_its_sql():
    assert set(load_all()) <= set(queries()) and set(load_all()) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())
    assert set(COMPARED) <= set(queries())


def test_contract_needs_no_session_to_load():
    code = "import __spark_entry__ as e; from pyspark.sql import SparkSession; e.queries(); e.oracle_sql(); " \
           "assert SparkSession.getActiveSession() is None"  # fmt: skip
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


@needs_tables
def test_entry_gives_daily_metrics(spark):
    result = entry(spark)
    assert result.columns == ["pickup_date", "trip_count", "total_revenue", "avg_fare", "avg_trip_distance", "card_tip_rate", "anomaly_share"]
    rows = result.collect()
    assert rows and [r.pickup_date for r in rows] == sorted(r.pickup_date for r in rows)


@needs_tables
@pytest.mark.parametrize("name", COMPARED)
def test_query_agrees_with_its_sql(spark, name):
    problems = check_oracle.compare(queries()[name](spark, SMOKE_DIR), check_oracle.connect(SMOKE_DIR), oracle_sql()[name])
    assert problems == []
