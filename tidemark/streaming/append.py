"""Append mode: final rows only, with Spark's own stream-stream join and watermarks.

A view's row comes out once the watermark has passed it, so it is never corrected. Late rows are dropped by Spark
without a dead letter, and its watermark is one for all partitions; where either matters, use update mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import Config
from ..operators.asof import seconds
from ..operators.quality import structural, too_far_ahead


def attribute_stream(events: DataFrame, cfg: Config = Config()) -> DataFrame:
    """events: a stream of parsed events of both kinds (see sources.parse), with arr as the clock."""
    ok = events.where(F.col("failed").isNull()) if "failed" in events.columns else events
    ok = ok.where(structural().isNull() & ~too_far_ahead(F.col("arr"), cfg)).withColumn("event_time", F.col("event_time").cast("timestamp"))
    late = f"{cfg.lateness} seconds"
    v = ok.where("kind = 'v'").select("user_id", F.col("event_time").alias("view_time"), "id", "url").withWatermark("view_time", late)
    c = ok.where("kind = 'c'").select(F.col("user_id").alias("click_user"), F.col("event_time").alias("click_time"), F.col("id").alias("click_id"), "campaign_id").withWatermark("click_time", late)
    near = (F.col("user_id") == F.col("click_user")) & (F.col("click_time") <= F.col("view_time")) & (F.col("click_time") >= F.col("view_time") - seconds(cfg.window))
    pairs = v.join(c, near, "leftOuter")
    # a stream may hold one event-time column: the window; sums with an empty interval are plain times
    plain = lambda c: F.col(c) + seconds(0)
    best = F.max(F.when(F.col("click_id").isNotNull(), F.struct(plain("click_time").alias("click_time"), "click_id", "campaign_id"))).alias("c")
    out = pairs.groupBy("id", "user_id", "url", F.window("view_time", "1 second").alias("w")).agg(F.max(plain("view_time")).alias("view_time"), best)
    return out.select(F.col("id").alias("page_view_id"), "user_id", F.col("view_time").alias("event_time"), "url", F.col("c.campaign_id").alias("attributed_campaign_id"),
                      F.col("c.click_id").alias("attributed_click_id"), F.col("c.click_time").alias("attributed_click_time"))
