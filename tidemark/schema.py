"""Column sets that operators take and return. Times are timestamps (NTZ in batch tables is fine)."""

#: JSON payloads.
CLICK_FIELDS = ("user_id", "event_time", "campaign_id", "click_id")
VIEW_FIELDS = ("user_id", "event_time", "url", "event_id")
#: Raw records of a source: what a Kafka source returns, with arr, the time of arrival.
RAW = "topic string, partition int, offset long, value string, arr timestamp"
#: One accepted or rejected event of either topic. kind: c (click) or v (view).
EVENT = "kind string, partition int, offset long, arr timestamp, user_id string, event_time timestamp, id string, campaign_id string, url string, value string"
ATTRIBUTED = "page_view_id string, user_id string, event_time timestamp, url string, attributed_campaign_id string, attributed_click_id string, attributed_click_time timestamp"
DEAD_LETTER = "key string, source_topic string, partition int, offset long, reason string, payload string"


def create_attributed(spark, name: str = "attributed_page_views", using: str = "parquet") -> None:
    """The table of results, if it isn't there. Its key is (page_view_id, user_id), which sinks.Table or a merge keeps."""
    needed = {"page_view_id", "user_id", "event_time", "url", "written_at"}
    columns = ", ".join(f"{c}{' NOT NULL' if c.split()[0] in needed else ''}" for c in [*ATTRIBUTED.split(", "), "written_at timestamp"])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using}")
