"""Streaming forms of quote staging, weekly windows, pinning and late scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import tuesday_start
from ..operators.matching import pin_events
from .latest import LatestTable, newest_version, run_available, state_on_disk
from .versions import VersionedTable
from .weeks import OpenWeeks, batch_watermark


def stream_odds(quotes: DataFrame, table: LatestTable, checkpoint: str) -> None:
    """Keep the newest quote per key. Repeated and late snapshots are harmless: the rule is a maximum."""
    run_available(quotes.writeStream.foreachBatch(lambda df, n: table.write_batch(df, n)), checkpoint)


def stream_quotes(quotes: DataFrame, table: VersionedTable, checkpoint: str, arrived: str, delay: str = "14 days") -> None:
    """Keep the newest quote per key, with bounded state and a bounded number of folders.

    Rows that were seen within ``delay`` of their first arrival, as in a file that is sent again, are dropped before they are
    written. ``arrived`` is the time of arrival and not the quote's own time: a quote of long ago that arrives now is no
    late row, so none is lost. A repetition after ``delay`` passes and changes nothing, since the rule is a maximum.

    The state has one digest of 128 bits for each row, in RocksDB: it lies on disk, and its memory is bounded.
    """
    columns = [c for c in quotes.columns if c != arrived]
    marked = quotes.withColumns(row_digest(columns)).withWatermark(arrived, delay)
    fresh = marked.dropDuplicatesWithinWatermark(list(row_digest(columns))).drop(arrived, *row_digest(columns))
    with state_on_disk(quotes.sparkSession):
        run_available(fresh.writeStream.foreachBatch(table.write_batch), checkpoint)


def row_digest(columns: list[str]) -> dict[str, Column]:
    """128 bits that tell rows apart. The hash passes over nulls, so which values are null is hashed as well."""
    values = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return {"_digest_1": F.xxhash64(*values), "_digest_2": F.xxhash64(F.lit(len(columns) + 1), *reversed(values))}


def week_window(ts: str):
    """Seven-day windows from Tuesday 00:00 UTC (the epoch began on a Thursday)."""
    return F.window(F.col(ts), "7 days", "7 days", "5 days")


def week_window_counts(rows: DataFrame, ts: str, by: list[str]) -> DataFrame:
    """Rows per Tuesday week and group; works on batch and streaming frames alike."""
    counted = rows.groupBy(week_window(ts).alias("_w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("_w.start").alias("week_start"), *by, "n")


def stream_week_windows(rows: DataFrame, ts: str, by: list[str], path: str, checkpoint: str) -> None:
    """Update-mode counts, one folder of changed groups per batch.

    The state holds one number per (week, group), so it needs no watermark and no row is late.
    """
    counts = week_window_counts(rows, ts, by)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run_available(counts.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def read_week_windows(spark, path: str, by: list[str]) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")
    return newest_version(rows, ["week_start", *by])


def stream_pin(events: DataFrame, games: DataFrame, path: str, checkpoint: str, **options) -> None:
    """Pin each micro-batch against the schedule; pinned and quarantined rows go to one table,
    split by the ``is_pinned`` folder, so the match runs once per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        matched = pin_events(batch, games, **options)
        (matched.withColumn("is_pinned", F.col("why").isNull())
         .write.mode("overwrite").partitionBy("is_pinned").parquet(f"{path}/batch_id={batch_id}"))

    run_available(events.writeStream.foreachBatch(write), checkpoint)


def split_late(finals: DataFrame, kickoff: str = "kickoff", reported: str = "reported_at",
               weeks_back: int = 2) -> DataFrame:
    """Mark finals whose game began before the lookback: the report's Tuesday week minus N weeks."""
    limit = tuesday_start(reported) - F.expr(f"INTERVAL {7 * weeks_back} DAYS")
    return finals.withColumn("is_late", F.col(kickoff) < limit)


def stream_late_scores(finals: DataFrame, path: str, checkpoint: str, keys: list[str], weeks_back: int = 2,
                       ties: list[str] | None = None) -> None:
    """Newest final per game within the lookback; finals behind it go to a table of their own."""
    on_time = LatestTable(f"{path}/on_time", keys, "reported_at", ties or [])

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = split_late(batch, weeks_back=weeks_back)
        on_time.write_batch(marked.where("NOT is_late").drop("is_late"), batch_id)
        marked.where("is_late").drop("is_late").write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")

    run_available(finals.writeStream.foreachBatch(write), checkpoint)


def stream_finals(finals: DataFrame, weeks: OpenWeeks, checkpoint: str, lookback: str = "14 days") -> None:
    """Finals into their weeks behind an event-time watermark on the kickoff; late ones go to a table of their own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        weeks.write_batch(batch, batch_id, batch_watermark(batch.sparkSession, checkpoint, batch_id))

    run_available(finals.withWatermark(weeks.kickoff, lookback).writeStream.foreachBatch(write), checkpoint)
