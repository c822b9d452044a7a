"""Results that change: corrections, and the guarded merge that keeps the latest click."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def merge(rows: DataFrame) -> DataFrame:
    """One row for each (page_view_id, user_id): that with the greatest (attributed_click_time, attributed_click_id as a
    string), a missing click being the least; ties keep the row of the greatest seq (a column of rows)."""
    rest = [c for c in rows.columns if c not in ("page_view_id", "user_id")]
    order = F.struct(F.col("attributed_click_time").isNotNull().alias("has"), "attributed_click_time", F.col("attributed_click_id").cast("string"), "seq")
    best = rows.groupBy("page_view_id", "user_id").agg(F.max_by(F.struct(*rest), order).alias("r"))
    return best.select("page_view_id", "user_id", *(f"r.{c}" for c in rest))


def corrections(initial: DataFrame, final: DataFrame) -> DataFrame:
    """Views whose attribution changed after they arrived."""
    key = ["page_view_id", "user_id"]
    old = initial.select(*key, F.col("attributed_click_id").alias("initial_click_id"))
    return final.join(old, key).where(~F.col("attributed_click_id").eqNullSafe(F.col("initial_click_id"))).select(
        *key, "event_time", "initial_click_id", "attributed_click_id", "attributed_campaign_id")
