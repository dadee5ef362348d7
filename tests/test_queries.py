"""Registered queries against their SQL on the smallest data set."""

import datetime as dt
import os

import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

QUICK = ["daily_sum", "ffill_limit7", "weekly_multi_agg", "lags_rolls", "cv_folds", "month_spread", "import_export", "outer_align",
         "energy_integral", "dup_ts_bump", "dedupe_last", "norm_text", "json_map_explode", "best_per_period", "in_period",
         "describe", "dim_calendar", "etl_exchange", "label_audit", "class_report", "base_week", "tail_split", "alias_filter",
         "csv_roundtrip", "union_by_name", "json_records", "request_status", "threshold_models"]
# All others run with ``-m slow``.
CHECKED = [pytest.param(n, marks=[] if n in QUICK else pytest.mark.slow) for n in sorted(entry_points.oracle_sql())]


def plain(v):
    if isinstance(v, float):
        return repr(v + 0.0) if v else "0.0"
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_registry():
    q, o = entry_points.queries(), entry_points.oracle_sql()
    assert set(o) <= set(q) and len(q) > 90


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    cur = duck.execute(entry_points.oracle_sql()[name])
    theirs = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(theirs)
    cols = sorted(df.columns)
    want = sorted(tuple(plain(r[theirs.index(c)]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 1122 and df.count() > 0
