"""Operational questions: offsets that can be committed, state, backpressure, topology."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import Config
from .asof import seconds


def committable(records: DataFrame) -> DataFrame:
    """records: topic, partition, offset, done. topic, partition, next_offset: after the run of done offsets from the
    first one on; no row where the first isn't done."""
    d = records.groupBy("topic", "partition").agg(F.min(F.when(~F.col("done"), F.col("offset"))).alias("open"), F.max("offset").alias("last"), F.min("offset").alias("first"))
    # the next offset is the first open one, but one after the last done one if offsets have gaps
    done = records.where("done").join(d, ["topic", "partition"]).where("open is null or offset < open")
    return done.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def retained(clicks: DataFrame, watermark: DataFrame, cfg: Config, evicted: bool = False) -> DataFrame:
    """Clicks that stay in the state, or those that leave it, given partition and joined_watermark: a click leaves
    when it is before the watermark by more than lateness and window."""
    d = clicks.join(F.broadcast(watermark.select("partition", "joined_watermark")), "partition", "left")  # a row for each source partition
    gone = F.coalesce(F.col("event_time") < F.col("joined_watermark") - seconds(cfg.lateness + cfg.window), F.lit(False))
    return d.where(gone if evicted else ~gone).drop("joined_watermark")


def state_sizes(clicks: DataFrame, every: str = "hour") -> DataFrame:
    """partition, at, arrived, in_total: clicks that arrived in each hour (or other unit) and until its end."""
    d = clicks.groupBy("partition", F.date_trunc(every, "arr").alias("at")).agg(F.count(F.lit(1)).alias("arrived"))
    order = Window.partitionBy("partition").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.withColumn("in_total", F.sum("arrived").over(order))


def hysteresis(sizes: DataFrame, column: str, high: int, low: int, keys: list[str], order: str) -> DataFrame:
    """sizes with paused: true from a size over high until one of low or less."""
    if low > high:
        raise ValueError("low must not be over high")
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = F.when(F.col(column) > high, True).when(F.col(column) <= low, False)
    return sizes.withColumn("paused", F.coalesce(F.last(turn, ignorenulls=True).over(w), F.lit(False)))


def breaker(calls: DataFrame, most: int, keys: list[str], order: str, slot: int = 100_000) -> DataFrame:
    """calls (ok boolean) with failures in a row, and paused: from `most` failures in a row until a success. order: a whole
    number that tells the calls of one key apart.

    The order is cut into slots of `slot` numbers: how many failures end each slot, carried on over slots without a success
    (few rows), and then the order within the slot. So a key's calls are no single task's work."""
    d = calls.withColumn("_slot", F.floor(F.col(order) / slot))
    last = F.max(F.when(F.col("ok"), F.col(order)))
    # of each slot: its last success, and the failures after that
    slots = d.groupBy(*keys, "_slot").agg(last.alias("_last"))
    after = d.join(slots, [*keys, "_slot"]).where(F.col("_last").isNull() | (F.col(order) > F.col("_last"))).groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_tail"))
    slots = slots.join(after, [*keys, "_slot"], "left").withColumn("_tail", F.coalesce("_tail", F.lit(0)))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("_tail").over(before), F.lit(0))  # failures at the ends of all slots before
    # the failures before the last slot that has a success don't count any more
    gone = F.max(F.when(F.col("_last").isNotNull(), F.col("_total"))).over(before)
    slots = slots.withColumn("_total", total).withColumn("_carry", F.col("_total") - F.coalesce(gone, F.lit(0))).select(*keys, "_slot", "_carry")
    inside = Window.partitionBy(*keys, "_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_run", F.sum(F.col("ok").cast("int")).over(inside))
    run = Window.partitionBy(*keys, "_slot", "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("failures", F.sum((~F.col("ok")).cast("int")).over(run)).join(slots, [*keys, "_slot"])
    d = d.withColumn("failures", F.col("failures") + F.when(F.col("_run") == 0, F.col("_carry")).otherwise(0)).drop("_slot", "_run", "_carry")
    return d.withColumn("paused", F.col("failures") >= most)


def topology(events: DataFrame, cfg: Config) -> DataFrame:
    """What breaks co-partitioning: users on several partitions, and partitions outside the configured ones."""
    users = events.groupBy("user_id").agg(F.countDistinct("partition").alias("n")).where("n > 1").select(
        F.lit("user on several partitions").alias("problem"), F.col("user_id").cast("string").alias("what"), F.col("n").cast("long").alias("n"))
    parts = events.where(~F.col("partition").between(0, cfg.partitions - 1)).groupBy("partition").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("partition outside the topology").alias("problem"), F.col("partition").cast("string").alias("what"), "n")
    return users.unionAll(parts)
