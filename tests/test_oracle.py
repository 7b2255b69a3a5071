"""Every registered query against its DuckDB oracle at sf0.01 (row count,
column names, order-insensitive value hash)."""

from __future__ import annotations

import sys, os
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import pytest

import __spark_entry__ as entry
from rental_mart.plans.keys import QUERIES
from oracle_compare import digest, duck

from conftest import SF01, SF001

KEYS = sorted(QUERIES)
ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, key):
    df = QUERIES[key](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(rows) > 0
        return
    dcols, drows = duck(SF01, ORACLE[key])
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["rent_dt", "rent_id", "rent_no", "rent_nm", "rent_type", "gender_cd",
                          "age_type", "use_cnt", "exer_amt", "carbon_amt", "move_meter", "move_time"]


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("key", ["fact_dw_daily", "station_load", "pages_unpack_fact"])
def test_small_scale(spark, key):
    df = QUERIES[key](spark, SF001)
    dcols, drows = duck(SF001, ORACLE[key])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(dcols, drows)[0]
