"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toArrow()
    checks = entry.oracle_sql()
    if name in checks:
        assert compare(got, con.sql(checks[name]).to_arrow_table()) == ""


def test_whole_queries_keep_every_game(spark):
    games = {r[0] for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey").collect()}
    for name in ("merge_preserving_all", "upsert_keep_best_all"):
        assert {r.game_id for r in entry.queries()[name](spark, SF).collect()} == games
    assert sum(r.n for r in entry.queries()["diff_rows_all"](spark, SF).collect()) == len(games)
    flags = entry.queries()["event_window_all"](spark, SF).collect()
    assert {(r.in_window, r.is_future, r.is_past) for r in flags} >= {(True, False, False), (False, True, False), (False, False, True)}
    row = entry.queries()["numeric_texts"](spark, SF).first()
    assert 0 < row.numeric_mixed < row.rows


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.limit(1).count() == 1
    assert "rating_vs_odds_favored_team" in df.columns
