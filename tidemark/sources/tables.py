"""The events table as ad clicks and page views, with a synthetic arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Config


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kind, partition, offset, arr, user_id, event_time, id, campaign_id, url. Rows of both kinds arrive up to 20
    minutes after they happened, in an order that follows from event_id alone."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type").isin("click", "view"))
    click = F.col("event_type") == "click"
    campaign = F.concat(F.lit("campaign_"), (F.get_json_object("props", "$.k").cast("int") % 10).cast("string"))
    return e.select(F.when(click, "c").otherwise("v").alias("kind"), F.pmod("user_id", F.lit(3)).cast("int").alias("partition"), F.col("event_id").alias("offset"),
                    F.expr("ts + make_interval(0, 0, 0, 0, 0, 0, (event_id * 7919) % 1200)").alias("arr"), "user_id", F.col("ts").alias("event_time"),
                    F.col("event_id").alias("id"), F.when(click, campaign).alias("campaign_id"), F.when(~click, F.concat(F.lit("/page/"), F.col("event_id").cast("string"))).alias("url"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("kind = 'c'").drop("kind", "url")


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("kind = 'v'").drop("kind", "campaign_id")


def raw_records(spark: SparkSession, sf_dir: str, cfg: Config = Config()) -> DataFrame:
    """The events as raw records with JSON payloads."""
    e = events(spark, sf_dir)
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    click = F.struct(F.col("user_id").cast("string").alias("user_id"), time.alias("event_time"), "campaign_id", F.col("id").cast("string").alias("click_id"))
    view = F.struct(F.col("user_id").cast("string").alias("user_id"), time.alias("event_time"), "url", F.col("id").cast("string").alias("event_id"))
    is_click = F.col("kind") == "c"
    return e.select(F.when(is_click, cfg.click_topic).otherwise(cfg.view_topic).alias("topic"), "partition", "offset",
                    F.when(is_click, F.to_json(click)).otherwise(F.to_json(view)).alias("value"), F.col("arr").cast("timestamp").alias("arr"))
