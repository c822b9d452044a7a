"""Validation, watermarks, lateness and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Config
from ..functions.parsing import blank
from .asof import seconds


def structural(strict: bool = False) -> Column:
    """The first reason that an event's own fields give, else NULL. strict also asks for an id and a view's url."""
    out = F.when(F.col("event_time").isNull(), "missing event_time").when(blank(F.col("user_id").cast("string")), "missing user_id")
    if strict:
        out = out.when(blank(F.col("id").cast("string")), F.when(F.col("kind") == "c", "missing click_id").otherwise("missing event_id"))
        out = out.when((F.col("kind") == "v") & blank(F.col("url")), "missing url")
    return out


def too_far_ahead(now: Column, cfg: Config) -> Column:
    return F.col("event_time") > now + seconds(cfg.skew)


def outside(cfg: Config) -> Column:
    """The reason of records from partitions that the topology doesn't have, else NULL."""
    return F.when(~F.col("partition").between(0, cfg.partitions - 1), "partition outside the topology")


def running_watermarks(valid: DataFrame, hours: int = 1) -> DataFrame:
    """valid with cw and vw: per partition, the greatest event_time of clicks and of views that arrived before the
    row. The order of arrival is that of arr, then topic, then offset, as in the stream. A partition's order is cut into slots of arrival time: each slot's maxima, then those of all slots before
    it (few rows), then the order within the slot. So a partition is no single task's work."""
    slot = F.floor(F.unix_seconds(F.col("arr").cast("timestamp")) / (3600 * hours))
    d = valid.withColumn("_slot", slot)
    time = lambda kind: F.when(F.col("kind") == kind, F.col("event_time"))
    ends = d.groupBy("partition", "_slot").agg(F.max(time("c")).alias("_c"), F.max(time("v")).alias("_v"))
    before = Window.partitionBy("partition").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("partition", "_slot", F.max("_c").over(before).alias("_c"), F.max("_v").over(before).alias("_v"))
    inside = Window.partitionBy("partition", "_slot").orderBy("arr", "kind", "offset").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_ci", F.max(time("c")).over(inside)).withColumn("_vi", F.max(time("v")).over(inside)).join(ends, ["partition", "_slot"])
    return d.withColumn("cw", F.greatest("_c", "_ci")).withColumn("vw", F.greatest("_v", "_vi")).drop("_slot", "_c", "_v", "_ci", "_vi")


def joined(cw: str = "cw", vw: str = "vw") -> Column:
    """The smaller of two watermarks, NULL until both exist."""
    return F.when(F.col(cw).isNotNull() & F.col(vw).isNotNull(), F.least(cw, vw))


def classify(events: DataFrame, now: Column, cfg: Config = Config(), strict: bool = False) -> DataFrame:
    """events with reason: why an event is rejected, NULL if it is accepted. The order: what parsing says (column
    failed, if there), a partition outside the topology, the event's fields, a time too far ahead, a time before the cutoff. Rejected events of all
    kinds but the last move no watermark; late ones can't."""
    failed = F.col("failed") if "failed" in events.columns else F.lit(None).cast("string")
    first = F.coalesce(failed, outside(cfg), structural(strict), F.when(too_far_ahead(now, cfg), "event_time too far in future"))
    d = events.withColumn("reason", first)
    marked = running_watermarks(d.where("reason is null"))
    late = F.coalesce(F.col("event_time") <= joined() - seconds(cfg.lateness), F.lit(False))
    marked = marked.withColumn("reason", F.when(late, "event_time before watermark cutoff")).drop("cw", "vw")
    return d.where("reason is not null").unionByName(marked)


def dead_letters(classified: DataFrame, cfg: Config = Config()) -> DataFrame:
    """key, source_topic, partition, offset, reason, payload of rejected events."""
    topic = F.when(F.col("kind") == "c", cfg.click_topic).otherwise(cfg.view_topic)
    value = F.col("value") if "value" in classified.columns else F.lit(None).cast("string")
    return classified.where("reason is not null").select(F.concat_ws(":", topic, "partition", "offset").alias("key"), topic.alias("source_topic"),
                                                         "partition", "offset", "reason", value.alias("payload"))


def joined_watermark(valid: DataFrame, idle: str | None = None) -> DataFrame:
    """partition, click_watermark, view_watermark, joined_watermark at the end of the data. idle: a kind (c or v) that
    is idle and caught up, so that the other carries."""
    d = valid.groupBy("partition").agg(F.max(F.when(F.col("kind") == "c", F.col("event_time"))).alias("click_watermark"),
                                       F.max(F.when(F.col("kind") == "v", F.col("event_time"))).alias("view_watermark"))
    both = joined("click_watermark", "view_watermark")
    other = {"c": F.col("view_watermark"), "v": F.col("click_watermark")}.get(idle)
    return d.withColumn("joined_watermark", both if other is None else F.greatest(both, other))
