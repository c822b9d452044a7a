"""Last-touch attribution: the latest click of the same user within a window before a view, or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def _text(column: str) -> Column:
    """Ids are compared as strings, in binary order."""
    return F.col(column).cast("string")


def attribute(views: DataFrame, clicks: DataFrame, window: int, strategy: str = "slots") -> DataFrame:
    """views: user_id, event_time, id, url; clicks: user_id, event_time, id, campaign_id. A row for each view, with
    the click of greatest (event_time, id as a string) from `window` seconds before the view to its time, both included.

    slots (default): time is cut into slots of one window; a click goes to its own slot and the next one, so a view
    finds all its clicks in its own. One shuffle by (user, slot), no fan-out, and no task holds a user's whole history.
    user: the same by user alone, for windows as long as the data. range: equi-join with a time range and max."""
    if strategy == "range":
        best = F.struct("event_time", _text("id").alias("key"), "id", "campaign_id")
        c = clicks.select(F.col("user_id").alias("_u"), F.col("event_time").alias("_t"), best.alias("_c"))
        near = (F.col("user_id") == F.col("_u")) & (F.col("_t") <= F.col("event_time")) & (F.col("_t") >= F.col("event_time") - seconds(window))
        out = views.select("user_id", "event_time", "id", "url").distinct().join(c, near, "left").groupBy("user_id", "event_time", "id", "url").agg(F.max("_c").alias("c"))
        return _named(out)
    v = views.select(F.lit("v").alias("kind"), "user_id", "event_time", "id", F.lit(None).cast("string").alias("campaign_id"), "url")
    c = clicks.select(F.lit("c").alias("kind"), "user_id", "event_time", "id", "campaign_id", F.lit(None).cast("string").alias("url"))
    return attribute_events(c.unionByName(v), window, strategy)


def attribute_events(events: DataFrame, window: int, strategy: str = "slots", every: bool = False) -> DataFrame:
    """attribute() for a frame of both kinds, which is read and computed once. every: all records come back, with kind,
    reason (a column of events then; rejected ones match nothing) and what accepted views are attributed to."""
    if strategy not in ("slots", "user"):
        raise ValueError(strategy)
    ok = F.col("reason").isNull() if every else F.lit(True)
    click = (F.col("kind") == "c") & ok
    d = events.select("kind", "user_id", "event_time", "id", "url", *(["reason"] if every else []), F.when(click, F.struct("event_time", "id", "campaign_id")).alias("c"))
    keys = ["user_id"]
    if every:  # rejected records may lack a user, and look for none
        d = d.withColumn("apart", F.when(~ok, F.xxhash64("id", "event_time", "user_id")))
        keys.append("apart")
    if strategy == "slots":
        slot = F.floor(F.unix_seconds(F.col("event_time").cast("timestamp")) / window)
        d = d.select("*", F.posexplode(F.when(click, F.array(slot, slot + 1)).otherwise(F.array(slot))).alias("copy", "slot"))
        keys.append("slot")
    else:
        d = d.withColumn("copy", F.lit(0))
    # clicks come before views of their time: c is before v
    order = Window.partitionBy(*keys).orderBy("event_time", "kind", _text("id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = d.withColumn("c", F.last("c", ignorenulls=True).over(order)).where("copy = 0" if every else "kind = 'v'")
    found = F.col("c.event_time") >= F.col("event_time") - seconds(window)
    if not every:
        return _named(out.withColumn("c", F.when(found, F.col("c"))))
    return out.withColumn("c", F.when(found & ok & (F.col("kind") == "v"), F.col("c"))).select(
        "kind", "id", "user_id", "reason", F.col("c.campaign_id").alias("attributed_campaign_id"), F.col("c.id").alias("attributed_click_id"))


def _named(out: DataFrame) -> DataFrame:
    return out.select(F.col("id").alias("page_view_id"), "user_id", "event_time", "url", F.col("c.campaign_id").alias("attributed_campaign_id"),
                      F.col("c.id").alias("attributed_click_id"), F.col("c.event_time").alias("attributed_click_time"))


def attribute_initially(views: DataFrame, clicks: DataFrame, window: int) -> DataFrame:
    """What each view was attributed to when it arrived: only clicks that arrived before it count, by arr, then topic (the
    clicks' is the first), then offset. Both need arr and offset. The clicks a view can match lie in one window, so the join's fan-out is that of one user's window."""
    slot = F.floor(F.unix_seconds(F.col("event_time").cast("timestamp")) / window)
    c = clicks.select(F.col("user_id").alias("_u"), F.explode(F.array(slot, slot + 1)).alias("_s"), F.col("event_time").alias("_t"),
                      F.struct("arr", F.lit(0), "offset").alias("_a"), F.struct("event_time", _text("id").alias("key"), "id", "campaign_id").alias("_c"))
    v = views.select("user_id", "event_time", "id", "url", F.struct("arr", F.lit(1), "offset").alias("a"), slot.alias("slot"))
    near = ((F.col("user_id") == F.col("_u")) & (F.col("slot") == F.col("_s")) & (F.col("_t") <= F.col("event_time"))
            & (F.col("_t") >= F.col("event_time") - seconds(window)) & (F.col("_a") < F.col("a")))
    return _named(v.join(c, near, "left").groupBy("user_id", "event_time", "id", "url").agg(F.max("_c").alias("c")))
