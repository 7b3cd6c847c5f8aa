"""Sketches, weeks rewritten only where they change, files in order."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from duelframe.operators import sketches
from duelframe.sources import weekly


def games(spark, n=60):
    base = dt.datetime(2025, 9, 6)
    rows = [(i, 2025, i % 3, base + dt.timedelta(minutes=i % 7), None if i == 4 else i * 2) for i in range(n)]
    return spark.createDataFrame(rows, "game_id int, season int, wk int, kickoff timestamp, score int")


def stamps(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_a_second_run_writes_nothing_and_one_game_rewrites_one_week(spark, tmp_path):
    path, marks = f"{tmp_path}/weeks", f"{tmp_path}/marks"
    df = games(spark)
    first = weekly.write_changed_weeks(df, path, marks)
    assert {(r.wk, r.rows, r.status) for r in first.collect()} == {(w, 20, "new") for w in range(3)}
    old, runs = stamps(path), os.listdir(marks)
    again = weekly.write_changed_weeks(df.orderBy(F.desc("game_id")), path, marks)
    assert {r.status for r in again.collect()} == {"unchanged"}
    assert stamps(path) == old and os.listdir(marks) == runs
    # A null that becomes a value, in the week of game 4.
    third = weekly.write_changed_weeks(df.fillna(1, ["score"]), path, marks)
    assert {r.wk: r.status for r in third.collect()} == {0: "unchanged", 1: "changed", 2: "unchanged"}
    new = stamps(path)
    assert {p for p in new if "wk=1" not in p} == {p for p in old if "wk=1" not in p} and new != old
    assert sorted(spark.read.parquet(path).select(*df.columns).collect()) == sorted(df.fillna(1, ["score"]).collect())


def test_weeks_that_are_gone_stay_and_repeated_rows_count(spark, tmp_path):
    path, marks = f"{tmp_path}/weeks", f"{tmp_path}/marks"
    df = games(spark)
    weekly.write_changed_weeks(df, path, marks)
    later = df.where("wk > 0").unionByName(df.where("game_id = 2"))
    got = weekly.write_changed_weeks(later, path, marks)
    assert {r.wk: r.status for r in got.collect()} == {0: "gone", 1: "unchanged", 2: "changed"}
    assert {r["wk"]: r["count"] for r in spark.read.parquet(path).groupBy("wk").count().collect()} == {0: 20, 1: 20, 2: 21}
    assert {r.status for r in weekly.write_changed_weeks(df.limit(0), path, marks).collect()} == {"gone"}


def test_a_run_cut_off_is_repeated(spark, tmp_path, monkeypatch):
    path, marks = f"{tmp_path}/weeks", f"{tmp_path}/marks"
    df = games(spark)
    weekly.write_changed_weeks(df, path, marks)
    whole = weekly.write_week

    def cut_off(*args):
        whole(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(weekly, "write_week", cut_off)
    with pytest.raises(RuntimeError):
        weekly.write_changed_weeks(df.withColumn("score", F.when(F.col("wk") == 2, 9).otherwise(F.col("score"))), path, marks)
    monkeypatch.setattr(weekly, "write_week", whole)
    # The old rows come again: week 2 holds the others and is rewritten.
    got = weekly.write_changed_weeks(df, path, marks)
    assert {r.wk: r.status for r in got.collect()} == {0: "unchanged", 1: "unchanged", 2: "changed"}
    assert sorted(spark.read.parquet(path).select(*df.columns).collect(), key=str) == sorted(df.collect(), key=str)


def test_ignored_columns_do_not_rewrite(spark, tmp_path):
    path, marks = f"{tmp_path}/weeks", f"{tmp_path}/marks"
    df = games(spark).withColumn("loaded", F.lit(1))
    weekly.write_changed_weeks(df, path, marks, ignore=("loaded",))
    got = weekly.write_changed_weeks(df.withColumn("loaded", F.lit(2)), path, marks, ignore=("loaded",))
    assert {r.status for r in got.collect()} == {"unchanged"}


def test_order_is_read_back_from_the_files(spark, tmp_path):
    df = games(spark, 500).repartition(5)
    weekly.write_sorted(df, f"{tmp_path}/s", ["wk", "kickoff", "game_id"], files=6)
    assert weekly.order_breaks(spark, f"{tmp_path}/s", ["wk", "kickoff", "game_id"]) == 0
    got = [r.game_id for r in weekly.read_sorted(spark, f"{tmp_path}/s").orderBy("ordinal").collect()]
    assert got == [r.game_id for r in df.orderBy("wk", "kickoff", "game_id").collect()]
    df.write.parquet(f"{tmp_path}/u")
    assert weekly.order_breaks(spark, f"{tmp_path}/u", ["wk", "kickoff", "game_id"]) > 0


def test_sketches_of_weeks_merge_for_any_span(spark, tmp_path):
    df = spark.range(200_000).select((F.col("id") % 10).alias("wk"), (F.col("id") * 7919 % 50_021).alias("team"))
    sketches.distinct_sketches(df, ["wk"], ["team"]).write.parquet(f"{tmp_path}/k")
    stored = spark.read.parquet(f"{tmp_path}/k")
    for weeks in (1, 4, 10):
        exact = df.where(F.col("wk") < weeks).select("team").distinct().count()
        got = sketches.span_distinct(stored.where(F.col("wk") < weeks), [], ["team"]).first().team_distinct
        assert abs(got - exact) <= 0.03 * exact
