"""First copies of events, and what later copies are."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_copies(events: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows with equal keys the one that arrived first. By aggregation, so copies meet combined."""
    rest = [c for c in events.columns if c not in keys]
    order = F.struct("arr", "offset", "partition")
    return events.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*(c if c in keys else f"r.{c}" for c in events.columns))


def clicks(events: DataFrame) -> DataFrame:
    return first_copies(events, ["user_id", "event_time", "id"])


def views(events: DataFrame) -> DataFrame:
    return first_copies(events, ["id", "user_id"])


def copies_from_elsewhere(events: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys first arrived at another partition and offset."""
    first = events.groupBy(*keys).agg(F.min(F.struct("arr", "offset", "partition")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = (F.col("f.offset") == F.col("offset")) & (F.col("f.partition") == F.col("partition"))
    return events.join(first, keys).where(~same).select(*events.columns, F.col("f.partition").alias("first_partition"), F.col("f.offset").alias("first_offset"))
