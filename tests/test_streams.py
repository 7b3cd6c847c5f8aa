"""Streams over several files and batches equal the batch result and survive a rerun."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duelframe.operators import matching
from duelframe.streaming import jobs
from duelframe.streaming import folders
from duelframe.streaming.latest import LatestTable
from duelframe.streaming.versions import VersionedTable
from duelframe.streaming.weeks import OpenWeeks

SCHEMA = "game_id long, market string, book string, fetch_ts timestamp, seq int"


@pytest.fixture()
def quotes(spark, tmp_path):
    base = dt.datetime(2025, 9, 1)
    rows = [(i % 7, "spreads" if i % 2 else "totals", "ab"[i % 3 == 0], base + dt.timedelta(hours=(i * 37) % 900), i) for i in range(300)]
    path = str(tmp_path / "in")
    for part in range(3):
        # Late rows, and the last file repeats the first.
        chunk = rows[(part % 2) * 150:(part % 2) * 150 + 150]
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return rows, path, stream


def test_latest_table(spark, quotes, tmp_path):
    rows, path, stream = quotes
    table = LatestTable(str(tmp_path / "t"), ["game_id", "market", "book"], "fetch_ts", ["seq"])
    jobs.stream_odds(stream, table, str(tmp_path / "cp"))
    want = {}
    for g, m, b, ts, seq in rows:
        best = want.get((g, m, b))
        if best is None or (ts, -seq) > (best[0], -best[1]):
            want[(g, m, b)] = (ts, seq)
    def state(t):
        return {(r.game_id, r.market, r.book): r.seq for r in t.read(spark).collect()}
    assert state(table) == {k: v[1] for k, v in want.items()}
    # A batch that runs again replaces its own folder.
    before = state(table)
    table.write_batch(spark.read.schema(SCHEMA).parquet(path).limit(0), 99)
    table.write_batch(spark.read.schema(SCHEMA).parquet(path), 1)
    table.write_batch(spark.read.schema(SCHEMA).parquet(path), 1)
    assert state(table) == before
    assert state(table.compact(spark, str(tmp_path / "compact"))) == before


def test_week_windows(spark, quotes, tmp_path):
    _, path, stream = quotes
    jobs.stream_week_windows(stream, "fetch_ts", ["market"], str(tmp_path / "w"), str(tmp_path / "cp"))
    got = sorted(map(tuple, jobs.read_week_windows(spark, str(tmp_path / "w"), ["market"]).collect()))
    want = sorted(map(tuple, jobs.week_window_counts(spark.read.schema(SCHEMA).parquet(path), "fetch_ts", ["market"]).collect()))
    assert got == want and all(r[0].weekday() == 1 for r in want)


def test_stream_pin_equals_batch(spark, tmp_path):
    base = dt.datetime(2025, 9, 1, 12)
    games = spark.createDataFrame([(i, base + dt.timedelta(days=i), "H%d" % (i % 3), "A") for i in range(20)],
                                  "game_id long, kickoff timestamp, home_id string, away_id string")
    rows = [(i, base + dt.timedelta(hours=11 * i), "H%d" % (i % 4), "A") for i in range(60)]
    schema = "event_id long, event_ts timestamp, home string, away string"
    path = str(tmp_path / "in")
    for part in range(2):
        spark.createDataFrame(rows[part * 30:part * 30 + 30], schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    jobs.stream_pin(stream, games, str(tmp_path / "t"), str(tmp_path / "cp"))
    out = spark.read.option("basePath", str(tmp_path / "t")).parquet(str(tmp_path / "t/batch_id=*"))
    got = {(r.event_id, r.game_id, r.why) for r in out.collect()}
    batch = matching.pin_events(spark.createDataFrame(rows, schema), games)
    assert got == {(r.event_id, r.game_id, r.why) for r in batch.collect()} and len(got) == 60


def test_late_scores_split(spark, tmp_path):
    rows = [(1, 10, 7, dt.datetime(2025, 9, 7), dt.datetime(2025, 9, 9)), (1, 13, 7, dt.datetime(2025, 9, 7), dt.datetime(2025, 9, 10)),
            (2, 3, 0, dt.datetime(2025, 9, 1), dt.datetime(2025, 9, 16)), (3, 3, 0, dt.datetime(2025, 9, 2), dt.datetime(2025, 9, 16))]
    schema = "game_id long, home_score int, away_score int, kickoff timestamp, reported_at timestamp"
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.parquet(path)
    jobs.stream_late_scores(spark.readStream.schema(schema).parquet(path), str(tmp_path / "t"), str(tmp_path / "cp"), ["game_id"])
    on_time = LatestTable(str(tmp_path / "t/on_time"), ["game_id"], "reported_at", []).read(spark)
    late = spark.read.option("basePath", str(tmp_path / "t/late")).parquet(str(tmp_path / "t/late/batch_id=*"))
    assert {(r.game_id, r.home_score) for r in on_time.collect()} == {(1, 13), (3, 3)}
    assert [r.game_id for r in late.collect()] == [2]


def newest(rows):
    want = {}
    for g, m, b, ts, seq in rows:
        best = want.get((g, m, b))
        if best is None or (ts, -seq) > (best[0], -best[1]):
            want[(g, m, b)] = (ts, seq)
    return {k: v[1] for k, v in want.items()}


def test_versioned_table_stays_small_and_survives_retries(spark, quotes, tmp_path, monkeypatch):
    rows, _, _ = quotes
    table = VersionedTable(str(tmp_path / "t"), ["game_id", "market", "book"], "fetch_ts", ["seq"], every=3)
    parts = [spark.createDataFrame(rows[i * 30:i * 30 + 30], SCHEMA) for i in range(10)]
    state = lambda: {(r.game_id, r.market, r.book): r.seq for r in table.read(spark).collect()}
    for n, part in enumerate(parts):
        table.write_batch(part, n)
        in_use = [x for x in folders.names(spark, table.path) if x.startswith(("delta-", "base-"))]
        assert len(in_use) <= 2 * 3 + 2 and len(folders.names(spark, f"{table.path}/versions")) <= 2
        assert state() == newest(rows[:30 * n + 30])
        # The same batch again, and cut off in the middle of what it does.
        table.write_batch(part, n)
        assert state() == newest(rows[:30 * n + 30])
    # The next batch merges (or not) and dies before its version is written, and between version and sweep.
    for step, numbers in (("write_text", range(10, 14)), ("delete", range(14, 18))):
        for n in numbers:
            with monkeypatch.context() as m:
                m.setattr(folders, step, lambda *a: (_ for _ in ()).throw(OSError("cut off")))
                try:
                    table.write_batch(parts[0], n)
                except OSError:
                    pass
            assert state() == newest(rows)
            table.write_batch(parts[0], n)
            assert state() == newest(rows)
    table.write_batch(parts[0].limit(0), 18)
    assert state() == newest(rows)


def test_stream_quotes_drops_repeated_files(spark, quotes, tmp_path):
    rows, path, _ = quotes
    table = VersionedTable(str(tmp_path / "t"), ["game_id", "market", "book"], "fetch_ts", ["seq"], every=2)
    written = []
    monkey = table.write_batch
    table.write_batch = lambda df, n: (written.append(df.count()), monkey(df, n))
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
              .select("*", F.col("_metadata.file_modification_time").alias("at")))
    jobs.stream_quotes(stream, table, str(tmp_path / "cp"), "at")
    # Three files, the last repeats the first: its rows are not written again.
    assert [n for n in written if n] == [150, 150]
    assert {(r.game_id, r.market, r.book): r.seq for r in table.read(spark).collect()} == newest(rows)
    # A quote of long ago that arrives now counts, also after a restart.
    old = (99, "spreads", "a", dt.datetime(1999, 1, 1), 1000)
    spark.createDataFrame([old], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    jobs.stream_quotes(stream, table, str(tmp_path / "cp"), "at")
    assert {(r.game_id, r.market, r.book): r.seq for r in table.read(spark).collect()} == newest([*rows, old])


def test_finals_behind_the_watermark(spark, tmp_path, monkeypatch):
    """Three runs over one checkpoint: late rows by the kickoffs of earlier batches, weeks close, open folders go."""
    day = lambda n: dt.datetime(2025, 9, 2) + dt.timedelta(days=n)  # noqa: E731  a Tuesday
    schema = "game_id long, home_score int, away_score int, kickoff timestamp, reported_at timestamp"
    batches = [[(1, 10, 7, day(0), day(1)), (2, 3, 0, day(5), day(6)), (1, 13, 7, day(0), day(2))],
               [(3, 20, 0, day(30), day(31)), (2, 6, 0, day(5), day(32)), (8, 1, 1, None, day(32))],
               [(4, 9, 9, day(3), day(40)), (5, 7, 7, day(20), day(40)), (3, 21, 0, day(30), day(41)), (6, 1, 0, day(16), day(41))],
               [(7, 2, 2, day(60), day(61))], [(5, 8, 8, day(20), day(62)), (7, 3, 2, day(60), day(62))]]
    weeks, path, cp = OpenWeeks(str(tmp_path / "t"), ["game_id"]), str(tmp_path / "in"), str(tmp_path / "cp")
    mark, late, kept, open_weeks = None, set(), {}, []
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        if n == 2:
            # Cut off between closing a week and deleting its folders, then run again.
            with monkeypatch.context() as m:
                m.setattr(folders, "delete", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
                with pytest.raises(Exception, match="cut off"):
                    jobs.stream_finals(stream, weeks, cp)
        jobs.stream_finals(stream, weeks, cp)
        for g, h, _, k, r in rows:
            if k is None or mark and k < mark:
                late.add((g, h))
            elif g not in kept or kept[g][1] < r:
                kept[g] = (h, r, k)
        assert {(r.game_id, r.home_score) for r in weeks.late(spark).collect()} == late
        got = {r.game_id: (r.home_score, r.is_closed) for r in weeks.read(spark).collect()}
        over = lambda k: bool(mark) and k - dt.timedelta(days=(k - day(0)).days % 7) + dt.timedelta(days=7) <= mark
        assert got == {g: (h, over(k)) for g, (h, _, k) in kept.items()}
        open_weeks.append(len(weeks.open_folders(spark)))
        newest_kickoff = max(k for *_, k, _ in rows if k)
        mark = max(mark or dt.datetime.min, newest_kickoff - dt.timedelta(days=14))
    assert late == {(8, 1), (4, 9), (5, 8)} and open_weeks[4] < open_weeks[3] <= 4
