"""Sources of raw records and their parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Config
from ..functions import bad_timestamp, lenient_timestamp, unknown_fields
from ..schema import CLICK_FIELDS, RAW, VIEW_FIELDS


def read_kafka(spark: SparkSession, servers: str, cfg: Config = Config(), most: int | None = None) -> DataFrame:
    """Both topics as a stream, from the earliest offsets and committed records only. Needs the Kafka connector."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", f"{cfg.click_topic},{cfg.view_topic}")
    reader = reader.option("startingOffsets", "earliest").option("kafka.isolation.level", "read_committed")
    if most:
        reader = reader.option("maxOffsetsPerTrigger", most)
    return reader.load().selectExpr("topic", "partition", "offset", "cast(value as string) value", "timestamp as arr")


def read_files(spark: SparkSession, path: str, stream: bool = False, most_files: int | None = None) -> DataFrame:
    """Raw records from JSON files with the columns of RAW."""
    reader = (spark.readStream if stream else spark.read).schema(RAW)
    if stream and most_files:
        reader = reader.option("maxFilesPerTrigger", most_files)
    return reader.json(path)


def parse(raw: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Events of both topics with `failed`: the reason where a payload doesn't parse (or its topic or partition is
    none of ours), else NULL. Unknown fields and times in other forms are failures."""
    click = F.col("topic") == cfg.click_topic
    fields = F.from_json("value", ", ".join(f"{f} string" for f in dict.fromkeys(CLICK_FIELDS + VIEW_FIELDS)))
    d = raw.select("topic", "partition", "offset", "arr", "value", fields.alias("j"))
    odd = F.when(click, unknown_fields(F.col("value"), CLICK_FIELDS)).otherwise(unknown_fields(F.col("value"), VIEW_FIELDS))
    bad = odd.isNull() | odd | F.col("j").isNull() | bad_timestamp(F.col("j.event_time"))
    failed = (F.when(~F.col("topic").isin(cfg.click_topic, cfg.view_topic) | F.col("topic").isNull(), "unknown topic")
              .when(~F.col("partition").between(0, cfg.partitions - 1), "partition outside the topology")
              .when(bad & click, "ad_click parse failed").when(bad, "page_view parse failed"))
    return d.select(F.when(click, "c").otherwise("v").alias("kind"), "partition", "offset", "arr", "j.user_id",
                    lenient_timestamp(F.col("j.event_time")).alias("event_time"),
                    F.when(click, F.col("j.click_id")).otherwise(F.col("j.event_id")).alias("id"), "j.campaign_id", "j.url", "value", failed.alias("failed"))
