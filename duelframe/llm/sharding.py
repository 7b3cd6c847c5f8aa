"""Shards of even size that keep linked documents together: balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked. The state of the propagation is a cell: the members of one group that started in
one shard. Cells move to the shard that holds most of their group while it has room; a group larger than a shard so
spreads over as few shards as its size needs, and no task ever holds a group. Row counts differ by one at most at the
end: members over a shard's quota and unlinked documents fill what is left.

Null texts count as empty for size and CRC but are linked with nothing; empty texts are equal texts. Repeated rows are
documents of their own. An empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import Stored

#: Rows that one window of the final numbering holds on average.
WINDOW_ROWS = 20_000


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 40, rounds: int = 6) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null): see the module text."""
    store = Stored(spark, "shards")
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    base = store.save(docs.select(
        "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2("text", 256)).alias("grp"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("home")))
    total = base.count()
    groups = base.where("grp is not null").groupBy("grp", "home").agg(F.count("*").alias("n"))
    linked = Window.partitionBy("grp")  # at most one row per shard
    cells = store.save(groups.withColumn("members", F.sum("n").over(linked)).where("members > 1")
                       .select("grp", "home", F.col("home").alias("at"), "n"))
    for _ in range(rounds):
        moved = store.save(_propagate(cells, total, shards))
        store.drop(cells)
        cells = moved
    placed = (base.join(cells.select("grp", "home", "at"), ["grp", "home"], "left")
              .withColumn("lane", F.coalesce("at", F.lit(-1))))
    return _fill(store, placed, total, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _propagate(cells: DataFrame, total: int, shards: int) -> DataFrame:
    """One round: every cell asks for the fullest shard of its group that has room; requests are granted by gain."""
    held = cells.groupBy("grp", "at").agg(F.sum("n").alias("held")).withColumn("tie", F.xxhash64("grp", "at"))
    wish = held.groupBy("grp").agg(F.max(F.struct("held", "tie", "at")).alias("wish"), F.sum("held").alias("members"))
    load = cells.join(wish, "grp").groupBy("at").agg(
        F.sum("n").alias("load"), F.sum(F.when(F.col("at") != F.col("wish.at"), F.col("n")).otherwise(0)).alias("leaving"))
    quota = total // shards
    # One row per shard: a proven bound for the broadcasts below. Those who wish to leave make room for others; should
    # they stay after all, the final filling moves what is over the quota.
    room = cells.sparkSession.range(shards).select(F.col("id").cast("int").alias("at")).join(load, "at", "left").select(
        "at", (F.greatest(F.lit(0), F.lit(quota) - F.coalesce("load", F.lit(0))) + F.coalesce("leaving", F.lit(0))).alias("room"))
    here = held.drop("tie").join(F.broadcast(room), "at")
    ranked = F.struct("held", F.xxhash64("grp", "at").alias("tie"), "at", "room")
    # A shard without room can still be the best place of the cells that are in it, so they stay.
    best = here.groupBy("grp").agg(F.max(ranked).alias("any"), F.max(F.when(F.col("room") > 0, ranked)).alias("free"))
    asks = cells.join(held, ["grp", "at"]).join(best, "grp").join(wish.select("grp", "members"), "grp")
    better = (F.col("free.at").isNotNull() & (F.col("free.at") != F.col("at")) & (F.col("n") <= F.col("free.room"))
              & ((F.col("held") < F.col("free.held")) | ((F.col("held") == F.col("free.held")) & (F.col("tie") < F.col("free.tie")))))
    asks = asks.select("grp", "home", "at", "n", "members", F.when(better, F.col("free.at")).alias("to"),
                       F.floor(F.log2(F.col("free.held") + 1)).cast("int").alias("gain"))
    # Demand by target and gain level: at most shards * 64 rows.
    demand = asks.where("to is not null").groupBy("to", "gain").agg(F.sum("n").alias("want"))
    before = Window.partitionBy("to").orderBy(F.desc("gain")).rowsBetween(Window.unboundedPreceding, -1)
    granted = (demand.withColumn("taken", F.coalesce(F.sum("want").over(before), F.lit(0)))
               .join(room.withColumnRenamed("at", "to"), "to")
               .select("to", "gain", ((F.col("room") - F.col("taken")) / F.col("want")).alias("share")))
    # The marginal level is granted to a part of its groups, chosen by hash: all cells of a group go alike, but those of
    # a group that no shard can hold go one by one.
    luck = F.pmod(F.xxhash64("grp", F.when(F.col("members") > quota, F.col("home")).otherwise(F.lit(-1))), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (asks.join(F.broadcast(granted), ["to", "gain"], "left")
            .select("grp", "home", F.when(luck < F.coalesce("share", F.lit(0.0)), F.col("to")).otherwise(F.col("at")).alias("at"), "n"))


def _fill(store: Stored, placed: DataFrame, total: int, shards: int) -> DataFrame:
    """Exact shards and slots from lanes (a shard, or -1 for unlinked documents)."""
    parts = max(1, total // (shards * WINDOW_ROWS) + 1)
    width = max(16, 1 << (parts - 1).bit_length())
    # Groups stay together in the order: first by the group's hash, then by the document's.
    spread = F.when(F.col("lane") >= 0, F.pmod(F.xxhash64("grp", F.lit(3)), F.lit(width))).otherwise(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(width)))
    within = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(16))
    keyed = placed.withColumn("block", (spread * 16 + within).cast("long"))
    order = Window.partitionBy("lane", "block").orderBy("grp", "doc_id", "size", "text_crc32")
    numbered = store.save(keyed.select("doc_id", "size", "text_crc32", "lane", "block", F.row_number().over(order).alias("row")))
    blocks = numbered.groupBy("lane", "block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("lane").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("lane", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    ranked = numbered.join(starts, ["lane", "block"]).withColumn("rank", F.col("start") + F.col("row") - 1)
    # One row per shard from here: quota, members kept, members over the quota, and where its free part starts.
    lanes = blocks.groupBy("lane").agg(F.sum("rows").alias("held"))
    free = lanes.where("lane = -1").agg(F.coalesce(F.sum("held"), F.lit(0)).alias("unlinked"))
    one = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    plan = (placed.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
            .join(lanes.withColumnRenamed("lane", "shard"), "shard", "left").fillna(0, ["held"])
            .withColumn("quota", F.lit(total // shards) + (F.col("shard") < total % shards).cast("long"))
            .withColumn("kept", F.least("held", "quota"))
            .withColumn("over_start", F.coalesce(F.sum(F.col("held") - F.col("kept")).over(one), F.lit(0)))
            .withColumn("free_start", F.coalesce(F.sum(F.col("quota") - F.col("kept")).over(one), F.lit(0)))
            .withColumn("free_end", F.col("free_start") + F.col("quota") - F.col("kept"))
            .crossJoin(F.broadcast(free)))
    plan = store.save(plan)
    own = plan.select(F.col("shard").alias("lane"), F.col("kept").alias("lane_kept"), "over_start", "unlinked")
    keyed = ranked.join(F.broadcast(own), "lane", "left").withColumn(
        "pool", F.when(F.col("lane") == -1, F.col("rank")).when(F.col("rank") >= F.col("lane_kept"),
                F.col("unlinked") + F.col("over_start") + F.col("rank") - F.col("lane_kept")))
    stay = keyed.where("pool is null").select("doc_id", "size", "text_crc32", F.col("lane").alias("shard"), F.col("rank").alias("slot"))
    ranges = plan.agg(F.sort_array(F.collect_list(F.struct("free_start", "free_end", "shard", "kept"))).alias("ranges"))
    target = F.element_at(F.filter("ranges", lambda r: (r["free_start"] <= F.col("pool")) & (F.col("pool") < r["free_end"])), 1)
    fill = (keyed.where("pool is not null").crossJoin(F.broadcast(ranges)).withColumn("target", target)
            .select("doc_id", "size", "text_crc32", F.col("target.shard").alias("shard"),
                    (F.col("target.kept") + F.col("pool") - F.col("target.free_start")).alias("slot")))
    return stay.union(fill)
