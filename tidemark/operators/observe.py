"""What a dashboard shows: counters, campaigns, latency, recent events and journeys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import Config
from .ops import retained
from .quality import joined_watermark

#: Upper bounds of the latency buckets in seconds, and their labels.
BOUNDS = (1, 5, 15, 60, 300)
LABELS = ("<=1s", "<=5s", "<=15s", "<=60s", "<=300s", ">300s")


def counters(events: DataFrame) -> DataFrame:
    """One row: records consumed of each kind, also those rejected; views attributed or found without a click; dead letters.
    events: a row for each record with kind, reason (null: accepted) and, of views, attributed_click_id. Views count once
    for each (id, user_id), as only true inserts do."""
    ok = F.col("reason").isNull() & (F.col("kind") == "v")
    key = F.when(ok, F.struct("id", "user_id"))
    first = events.groupBy("kind", key.alias("view"), F.when(~ok, F.col("reason").isNotNull()).alias("dead")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("attributed_click_id").isNotNull().cast("int")).alias("clicked"))
    n = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    view = F.col("view").isNotNull()
    return first.agg(n(F.col("kind") == "c")("clicks_consumed"), n(F.col("kind") == "v")("views_consumed"), F.count_if(view).alias("views_attributed"),
                     F.count_if(view & (F.col("clicked") == 1)).alias("views_with_click"), n(F.col("dead"))("dead_letters"))


def campaign_credit(initial: DataFrame) -> DataFrame:
    return initial.where("attributed_campaign_id is not null").groupBy("attributed_campaign_id").agg(F.count(F.lit(1)).alias("credit"))


def top(credit: DataFrame, k: int) -> DataFrame:
    return credit.orderBy(F.desc("credit"), "attributed_campaign_id").limit(max(0, k))


def latency_histogram(latencies: DataFrame, column: str) -> DataFrame:
    """bucket, n for each of the six buckets, in order; latencies in seconds, whole ones, negative ones as 0."""
    s = F.greatest(F.floor(column), F.lit(0))
    bucket = F.lit(len(BOUNDS))
    for i in reversed(range(len(BOUNDS))):
        bucket = F.when(s <= BOUNDS[i], i).otherwise(bucket)
    n = latencies.where(F.col(column).isNotNull()).groupBy(bucket.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    spark = latencies.sparkSession
    names = spark.createDataFrame(list(enumerate(LABELS)), "i int, bucket string")
    return names.join(n, "i", "left").select("i", "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def recent(events: DataFrame, n: int, *order: str) -> DataFrame:
    """The n newest events, newest first."""
    return events.orderBy(*(F.desc(c) for c in order)).limit(max(0, n))


def by_id(events: DataFrame, event_id) -> DataFrame:
    """The event's rows; none where it isn't known."""
    return events.where(F.col("id") == event_id)


def journeys(steps: DataFrame) -> DataFrame:
    """id, steps array<struct<at,label>> in order; steps: id, at, label."""
    return steps.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "label"))).alias("steps"))


def staleness(events: DataFrame, now) -> DataFrame:
    """kind, partition, seconds since an arrival last raised the watermark. The first row to reach the final maximum
    did, so no running order is needed."""
    top_time = events.groupBy("kind", "partition").agg(F.max("event_time").alias("top"))
    at = events.join(top_time, ["kind", "partition"]).where(F.col("event_time") == F.col("top")).groupBy("kind", "partition").agg(F.min("arr").alias("at"))
    return at.select("kind", "partition", F.timestamp_diff("SECOND", F.col("at"), now).alias("seconds"))


def dashboard(events: DataFrame, now, cfg: Config = Config()) -> DataFrame:
    """A row for each configured partition, also those without events: partition, joined_watermark, seconds since it last
    advanced, clicks in the state. It advanced when the later of both topics first reached its value."""
    joined = joined_watermark(events).select("partition", "joined_watermark")
    every = events.sparkSession.range(cfg.partitions).select(F.col("id").cast("int").alias("partition")).join(joined, "partition", "left")
    marks = F.broadcast(joined.where("joined_watermark is not null"))  # a row for each source partition
    reached = events.join(marks, "partition").where(F.col("event_time") >= F.col("joined_watermark")).groupBy("partition", "kind").agg(F.min("arr").alias("at"))
    reached = reached.groupBy("partition").agg(F.max("at").alias("at"))
    held = retained(events.where("kind = 'c'"), joined, cfg).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    out = every.join(reached, "partition", "left").join(held, "partition", "left")
    return out.select("partition", "joined_watermark", F.timestamp_diff("SECOND", F.col("at"), now).alias("seconds"), F.coalesce("n", F.lit(0)).alias("clicks"))


def event_log(events: DataFrame, attributions: DataFrame, capacity: int = 500) -> DataFrame:
    """The bounded log: ring (live or attributed), id, at, place (from 0, newest first). live: the last `capacity` different
    ids by their first arrival; attributed: the same of the ids that reached an attribution, which consumption can't
    evict. events, attributions: id, arr, kind, offset. An id that comes again isn't new, even if it was evicted."""
    def ring(rows: DataFrame, name: str) -> DataFrame:
        first = rows.groupBy("id").agg(F.min(F.struct("arr", "kind", "offset")).alias("f"))
        last = first.orderBy(F.desc("f")).limit(max(0, capacity))  # at most `capacity` rows from here on
        place = F.row_number().over(Window.orderBy(F.desc("f"))) - 1
        return last.select(F.lit(name).alias("ring"), "id", F.col("f.arr").alias("at"), place.alias("place"))

    return ring(events, "live").unionAll(ring(attributions, "attributed"))
