"""The query catalogue over the events table, and the SQL that each has to agree with.

Inputs without natural duplicates, ties or lateness get them from rules on event_id; see the comments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Config
from ..operators import asof, dedup, observe, ops, quality, updates
from ..functions import bad_timestamp, lenient_timestamp
from ..operators.asof import seconds
from ..sources import clicks, events, parse, raw_records, views

CFG = Config()
MINUTE, HOUR = 60, 3600
#: The clock of queries that need one: a fixed time, so that results don't depend on the day.
NOW = "2024-02-10 00:00:00"
SQL_E = """e AS (SELECT CASE WHEN event_type = 'click' THEN 'c' ELSE 'v' END AS kind, CAST(user_id % 3 AS INT) AS "partition", event_id AS "offset",
  ts + to_seconds((event_id * 7919) % 1200) AS arr, user_id, ts AS event_time, event_id AS id,
  CASE WHEN event_type = 'click' THEN 'campaign_' || (CAST(json_extract_string(props, '$.k') AS INT) % 10) END AS campaign_id,
  CASE WHEN event_type = 'view' THEN '/page/' || event_id END AS url
  FROM events WHERE event_type IN ('click', 'view')),
c AS (SELECT * FROM e WHERE kind = 'c'), v AS (SELECT * FROM e WHERE kind = 'v')"""
_OUT = "page_view_id, user_id, event_time, url, attributed_campaign_id, attributed_click_id, attributed_click_time"


def sql_attribute(window: int, v: str = "v", c: str = "c", more: str = "") -> str:
    """The attribution of view table v with click table c, as a query."""
    return f"""SELECT v.id AS page_view_id, v.user_id, v.event_time, v.url, c.campaign_id AS attributed_campaign_id, c.id AS attributed_click_id, c.event_time AS attributed_click_time
  FROM {v} AS v LEFT JOIN {c} AS c ON c.user_id = v.user_id AND c.event_time <= v.event_time AND c.event_time >= v.event_time - to_seconds({window}) {more}
  QUALIFY row_number() OVER (PARTITION BY v.id, v.user_id ORDER BY c.event_time DESC NULLS LAST, CAST(c.id AS VARCHAR) DESC NULLS LAST) = 1"""


SQL_MARKED = """w AS (SELECT *, max(CASE WHEN kind = 'c' THEN event_time END) OVER x AS cw, max(CASE WHEN kind = 'v' THEN event_time END) OVER x AS vw FROM e
  WINDOW x AS (PARTITION BY "partition" ORDER BY arr, kind, "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
_LATE = "cw IS NOT NULL AND vw IS NOT NULL AND event_time <= least(cw, vw) - to_seconds({})"
SQL_SAID = f"""{SQL_MARKED}, s AS (SELECT *, CASE WHEN {_LATE.format(CFG.lateness)} THEN 'event_time before watermark cutoff' END AS reason FROM w)"""

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        Q[key] = f
        if sql is not None:
            SQL[key] = f"WITH {SQL_E} {sql}"
        return f

    return add


# ---- sources, projections, parsing

@query('SELECT id AS page_view_id, user_id, event_time, url, "partition", "offset" FROM v')
def scan_page_views(spark, d):
    return views(spark, d).select(F.col("id").alias("page_view_id"), "user_id", "event_time", "url", "partition", "offset")


@query('SELECT id AS click_id, user_id, event_time, campaign_id, "partition", "offset" FROM c')
def scan_ad_clicks(spark, d):
    return clicks(spark, d).select(F.col("id").alias("click_id"), "user_id", "event_time", "campaign_id", "partition", "offset")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'campaign_' || (CAST(json_extract_string(props, '$.k') AS INT) % 10) AS campaign_id FROM events WHERE event_type = 'click'")
def parse_props_campaign(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").where("event_type = 'click'")
    k = F.from_json("props", "k bigint")["k"]
    return e.select("event_id", k.alias("k"), F.concat(F.lit("campaign_"), (k % 10).cast("string")).alias("campaign_id"))


#: Every 11th payload is cut short, every 13th has a field too many, every 17th a time in another form.
@query("""SELECT kind, id AS "offset", CASE WHEN id % 11 = 0 OR id % 13 = 0 OR id % 17 = 0 THEN CASE WHEN kind = 'c' THEN 'ad_click parse failed' ELSE 'page_view parse failed' END END AS failed FROM e""")
def parse_strict_json(spark, d):
    raw = raw_records(spark, d)
    v = F.col("value")
    v = F.when(F.col("offset") % 17 == 0, F.regexp_replace(v, r'("event_time":"\d{4}-\d{2}-\d{2})T[^"]*', "$1")).otherwise(v)
    v = F.when(F.col("offset") % 13 == 0, F.regexp_replace(v, r"\}$", ',"extra":1}')).otherwise(v)
    v = F.when(F.col("offset") % 11 == 0, F.expr("left(value, length(value) - 3)")).otherwise(v)
    return parse(raw.withColumn("value", v)).select("kind", "offset", "failed")


@query("SELECT id, date_trunc('second', event_time) AS event_time FROM e")
def truncate_event_time(spark, d):
    return events(spark, d).select("id", F.date_trunc("second", "event_time").cast("timestamp_ntz").alias("event_time"))


#: A time's text in one of eight forms by id; those of 5 to 7 are none.
@query("""SELECT id, CASE WHEN id % 8 < 5 THEN date_trunc('second', CASE id % 8 WHEN 1 THEN date_trunc('minute', event_time) ELSE event_time END) - CASE WHEN id % 8 = 4 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END END AS event_time,
  id % 8 IN (5, 6) AS bad FROM e""")
def lenient_times(spark, d):
    as_text = lambda form: F.date_format("event_time", form)
    forms = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss'Z'", "' 'yyyy-MM-dd'T'HH:mm:ss.SSS'Z '", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]
    text = F.lit("  ")
    for i, form in enumerate(forms):
        text = F.when(F.col("id") % 8 == i, as_text(form)).otherwise(text)
    return events(spark, d).withColumn("text", text).select("id", lenient_timestamp(F.col("text")).cast("timestamp_ntz").alias("event_time"), bad_timestamp(F.col("text")).alias("bad"))


# ---- validation, watermarks, dead letters

def _faulty(e: DataFrame) -> DataFrame:
    """Every 19th event lacks its time, every 23rd its user, every 29th is 400 days ahead."""
    i = F.col("id")
    time = F.when(i % 19 == 0, None).when(i % 29 == 0, F.col("event_time") + F.make_dt_interval(F.lit(400))).otherwise(F.col("event_time"))
    return e.withColumn("event_time", time).withColumn("user_id", F.when(i % 23 != 0, F.col("user_id")))


_FAULTY = """f AS (SELECT * REPLACE (CASE WHEN id % 19 = 0 THEN NULL WHEN id % 29 = 0 THEN event_time + INTERVAL 400 DAY ELSE event_time END AS event_time,
  CASE WHEN id % 23 = 0 THEN NULL ELSE user_id END AS user_id) FROM e)"""
_AHEAD = "event_time > arr + to_seconds(300)"


@query(f""", {_FAULTY} SELECT id, CASE WHEN event_time IS NULL THEN 'missing event_time' WHEN user_id IS NULL THEN 'missing user_id' END AS reason FROM f""")
def validate_events(spark, d):
    return _faulty(events(spark, d)).select("id", quality.structural().alias("reason"))


@query(f", {_FAULTY} SELECT id, event_time FROM f WHERE {_AHEAD}")
def future_skew_reject(spark, d):
    return _faulty(events(spark, d)).where(quality.too_far_ahead(F.col("arr"), CFG)).select("id", "event_time")


@query(f', {SQL_MARKED} SELECT "partition", "offset", cw, vw FROM w')
def running_watermarks(spark, d):
    return quality.running_watermarks(events(spark, d)).select("partition", "offset", "cw", "vw")


@query(""", j AS (SELECT "partition", max(CASE WHEN kind = 'c' THEN event_time END) AS click_watermark, max(CASE WHEN kind = 'v' THEN event_time END) AS view_watermark FROM e GROUP BY 1)
SELECT *, CASE WHEN click_watermark IS NOT NULL AND view_watermark IS NOT NULL THEN least(click_watermark, view_watermark) END AS joined_watermark FROM j""")
def joined_watermark(spark, d):
    return quality.joined_watermark(events(spark, d))


@query(""", j AS (SELECT "partition", max(event_time) FILTER (kind = 'c') AS cw, max(event_time) FILTER (kind = 'v') AS vw FROM e WHERE kind = 'c' OR id % 4 = 0 GROUP BY 1)
SELECT "partition", greatest(cw, least(cw, vw)) AS joined_watermark FROM j WHERE cw IS NOT NULL""")
def joined_watermark_idle_views(spark, d):
    e = events(spark, d).where("kind = 'c' or id % 4 = 0")
    return quality.joined_watermark(e, idle="v").where("joined_watermark is not null").select("partition", "joined_watermark")


@query(f', {SQL_SAID} SELECT kind, "partition", "offset", event_time FROM s WHERE reason IS NOT NULL')
def too_late_events(spark, d):
    return quality.classify(events(spark, d), F.col("arr"), CFG).where("reason is not null").select("kind", "partition", "offset", "event_time")


_CLASSIFIED = f"""{_FAULTY}, g AS (SELECT *, CASE WHEN event_time IS NULL THEN 'missing event_time' WHEN user_id IS NULL THEN 'missing user_id' WHEN {_AHEAD} THEN 'event_time too far in future' END AS first FROM f),
m AS (SELECT *, max(CASE WHEN kind = 'c' THEN event_time END) OVER x AS cw, max(CASE WHEN kind = 'v' THEN event_time END) OVER x AS vw FROM g WHERE first IS NULL
  WINDOW x AS (PARTITION BY "partition" ORDER BY arr, kind, "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
said AS (SELECT kind, "partition", "offset", first AS reason FROM g WHERE first IS NOT NULL UNION ALL
  SELECT kind, "partition", "offset", 'event_time before watermark cutoff' FROM m WHERE {_LATE.format(CFG.lateness)})"""


def _dead(spark, d) -> DataFrame:
    return quality.dead_letters(quality.classify(_faulty(events(spark, d)), F.col("arr"), CFG), CFG)


@query(f""", {_CLASSIFIED} SELECT CASE WHEN kind = 'c' THEN 'ad_clicks' ELSE 'page_views' END || ':' || "partition" || ':' || "offset" AS "key",
  CASE WHEN kind = 'c' THEN 'ad_clicks' ELSE 'page_views' END AS source_topic, "partition", "offset", reason FROM said""")
def dead_letter_envelope(spark, d):
    return _dead(spark, d).drop("payload")


_PAYLOAD = """'{"user_id":"' || user_id || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') || '",' || CASE WHEN kind = 'c' THEN '"campaign_id":"' || campaign_id || '","click_id":"' ELSE '"url":"' || url || '","event_id":"' END || id || '"}'"""


#: Raw records with JSON payloads; every 11th is cut short. A dead letter has the payload as it came.
@query(f""", t AS (SELECT * REPLACE (date_trunc('second', event_time) AS event_time), {_PAYLOAD} AS whole FROM e),
p AS (SELECT *, CASE WHEN id % 11 = 0 THEN left(whole, len(whole) - 3) ELSE whole END AS payload, CASE WHEN id % 11 = 0 THEN CASE WHEN kind = 'c' THEN 'ad_click parse failed' ELSE 'page_view parse failed' END END AS first FROM t),
m AS (SELECT *, max(CASE WHEN kind = 'c' THEN event_time END) OVER x AS cw, max(CASE WHEN kind = 'v' THEN event_time END) OVER x AS vw FROM p WHERE first IS NULL
  WINDOW x AS (PARTITION BY "partition" ORDER BY arr, kind, "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
said AS (SELECT kind, "partition", "offset", first AS reason, payload FROM p WHERE first IS NOT NULL UNION ALL
  SELECT kind, "partition", "offset", 'event_time before watermark cutoff', payload FROM m WHERE {_LATE.format(CFG.lateness)})
SELECT CASE WHEN kind = 'c' THEN 'ad_clicks' ELSE 'page_views' END || ':' || "partition" || ':' || "offset" AS "key", reason, payload FROM said""")
def dead_letter_payload(spark, d):
    raw = raw_records(spark, d)
    raw = raw.withColumn("value", F.when(F.col("offset") % 11 == 0, F.expr("left(value, length(value) - 3)")).otherwise(F.col("value")))
    return quality.dead_letters(quality.classify(parse(raw), F.col("arr"), CFG), CFG).select("key", "reason", "payload")


@query(f", {_CLASSIFIED} SELECT reason, count(*) AS n FROM said GROUP BY 1")
def dead_letter_by_reason(spark, d):
    return _dead(spark, d).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- duplicates

def _copied(e: DataFrame) -> DataFrame:
    """Every 7th event arrives again a minute later, at another offset and in the next partition."""
    again = e.where("id % 7 = 0").withColumn("offset", F.col("offset") + 10_000_000).withColumn("arr", F.col("arr") + seconds(60))
    return e.unionByName(again.withColumn("partition", (F.col("partition") + 1) % 3))


_COPIED = """d AS (SELECT * FROM e UNION ALL SELECT * REPLACE ("offset" + 10000000 AS "offset", arr + INTERVAL 60 SECOND AS arr, ("partition" + 1) % 3 AS "partition") FROM e WHERE id % 7 = 0)"""


@query(f""", {_COPIED} SELECT user_id, event_time, id AS click_id, campaign_id, "offset" FROM d WHERE kind = 'c' QUALIFY row_number() OVER (PARTITION BY user_id, event_time, id ORDER BY arr, "offset") = 1""")
def dedup_clicks(spark, d):
    return dedup.clicks(_copied(clicks(spark, d))).select("user_id", "event_time", F.col("id").alias("click_id"), "campaign_id", "offset")


@query(f""", {_COPIED} SELECT id AS page_view_id, user_id, event_time, url, "offset" FROM d WHERE kind = 'v' QUALIFY row_number() OVER (PARTITION BY id, user_id ORDER BY arr, "offset") = 1""")
def dedup_page_views(spark, d):
    return dedup.views(_copied(views(spark, d))).select(F.col("id").alias("page_view_id"), "user_id", "event_time", "url", "offset")


@query(f""", {_COPIED}, r AS (SELECT *, first_value("partition") OVER x AS first_partition, first_value("offset") OVER x AS first_offset FROM d WHERE kind = 'c' WINDOW x AS (PARTITION BY user_id, event_time, id ORDER BY arr, "offset"))
SELECT id AS click_id, "partition", "offset", first_partition, first_offset FROM r WHERE "partition" <> first_partition OR "offset" <> first_offset""")
def duplicate_source_offsets(spark, d):
    return dedup.copies_from_elsewhere(_copied(clicks(spark, d)), ["user_id", "event_time", "id"]).select(F.col("id").alias("click_id"), "partition", "offset", "first_partition", "first_offset")


# ---- attribution

def _attribution(window: int, strategy: str):
    if strategy == "range":
        return lambda spark, d: asof.attribute(views(spark, d), clicks(spark, d), window, strategy)
    return lambda spark, d: asof.attribute_events(events(spark, d), window, strategy)


for _name, _window, _strategy in (("attribute_last_touch", 30 * MINUTE, "slots"), ("attribute_last_touch_3h", 3 * HOUR, "slots"), ("attribute_last_touch_24h", 24 * HOUR, "slots"),
                                  ("attribute_by_user", 24 * HOUR, "user"), ("attribute_range_join", 24 * HOUR, "range")):
    query(sql_attribute(_window), _name)(_attribution(_window, _strategy))


@query(f""", h AS (SELECT * REPLACE (date_trunc('hour', event_time) AS event_time) FROM e), hv AS (SELECT * FROM h WHERE kind = 'v'), hc AS (SELECT * FROM h WHERE kind = 'c')
{sql_attribute(24 * HOUR, "hv", "hc")}""")
def attribute_ties(spark, d):
    hour = F.date_trunc("hour", "event_time").cast("timestamp_ntz")
    return asof.attribute_events(events(spark, d).withColumn("event_time", hour), 24 * HOUR)


#: Times of half days, so that many clicks share one: ids of different lengths are told apart as strings.
@query(f""", h AS (SELECT * REPLACE (time_bucket(INTERVAL 12 HOUR, event_time) AS event_time, 'e' || id AS id) FROM e), hv AS (SELECT * FROM h WHERE kind = 'v'), hc AS (SELECT * FROM h WHERE kind = 'c')
{sql_attribute(24 * HOUR, "hv", "hc")}""")
def attribute_ties_of_strings(spark, d):
    half = F.window(F.col("event_time").cast("timestamp"), "12 hours")["start"].cast("timestamp_ntz")
    return asof.attribute_events(events(spark, d).withColumns({"event_time": half, "id": F.concat(F.lit("e"), "id")}), 24 * HOUR)


def _accepted(spark, d) -> DataFrame:
    return quality.classify(events(spark, d), F.col("arr"), CFG).where("reason is null")


_ACCEPTED = f"{SQL_SAID}, ac AS (SELECT * FROM s WHERE reason IS NULL AND kind = 'c'), av AS (SELECT * FROM s WHERE reason IS NULL AND kind = 'v')"


@query(f", {_ACCEPTED} {sql_attribute(3 * HOUR, 'av', 'ac')}")
def attribute_accepted_only(spark, d):
    return asof.attribute_events(_accepted(spark, d), 3 * HOUR)


@query(f", a AS ({sql_attribute(24 * HOUR)}) SELECT page_view_id, user_id FROM a WHERE attributed_click_id IS NOT NULL")
def attributed_only(spark, d):
    return _attribution(24 * HOUR, "slots")(spark, d).where("attributed_click_id is not null").select("page_view_id", "user_id")


@query(f", a AS ({sql_attribute(24 * HOUR)}) SELECT page_view_id, user_id FROM a WHERE attributed_click_id IS NULL")
def unattributed_views(spark, d):
    return _attribution(24 * HOUR, "slots")(spark, d).where("attributed_click_id is null").select("page_view_id", "user_id")


_BEFORE = 'AND (c.arr, c.kind, c."offset") < (v.arr, v.kind, v."offset")'


def _initial(spark, d) -> DataFrame:
    return asof.attribute_initially(views(spark, d), clicks(spark, d), 24 * HOUR)


@query(sql_attribute(24 * HOUR, more=_BEFORE))
def initial_attribution(spark, d):
    return _initial(spark, d)


@query(f""", i AS ({sql_attribute(24 * HOUR, more=_BEFORE)}), a AS ({sql_attribute(24 * HOUR)})
SELECT a.page_view_id, a.user_id, a.event_time, i.attributed_click_id AS initial_click_id, a.attributed_click_id, a.attributed_campaign_id
FROM a JOIN i USING (page_view_id, user_id) WHERE a.attributed_click_id IS DISTINCT FROM i.attributed_click_id""")
def corrections_applied(spark, d):
    return updates.corrections(_initial(spark, d), _attribution(24 * HOUR, "slots")(spark, d))


_CREDIT = f"i AS ({sql_attribute(24 * HOUR, more=_BEFORE)}), k AS (SELECT attributed_campaign_id, count(*) AS credit FROM i WHERE attributed_campaign_id IS NOT NULL GROUP BY 1)"


@query(f", {_CREDIT} SELECT * FROM k")
def campaign_credit_initial(spark, d):
    return observe.campaign_credit(_initial(spark, d))


@query(f", {_CREDIT} SELECT * FROM k ORDER BY credit DESC, attributed_campaign_id LIMIT 5")
def top_campaigns(spark, d):
    return observe.top(observe.campaign_credit(_initial(spark, d)), 5)


#: The table holds the attribution of a 3 h window; rows of a 24 h window come for the even views, and of none for the rest.
@query(f""", o AS ({sql_attribute(3 * HOUR)}), n AS ({sql_attribute(24 * HOUR)}),
r AS (SELECT *, 0 AS seq FROM o UNION ALL SELECT *, 1 FROM n WHERE page_view_id % 2 = 0 UNION ALL SELECT page_view_id, user_id, event_time, url, NULL, NULL, NULL, 1 FROM n WHERE page_view_id % 2 = 1)
SELECT {_OUT} FROM r QUALIFY row_number() OVER (PARTITION BY page_view_id, user_id ORDER BY attributed_click_time DESC NULLS LAST, CAST(attributed_click_id AS VARCHAR) DESC NULLS LAST, seq DESC) = 1""")
def upsert_merge_guard(spark, d):
    old, new = (_attribution(w, "slots")(spark, d) for w in (3 * HOUR, 24 * HOUR))
    none = {c: F.lit(None).cast(dict(new.dtypes)[c]) for c in ("attributed_campaign_id", "attributed_click_id", "attributed_click_time")}
    rows = old.withColumn("seq", F.lit(0)).unionByName(new.where("page_view_id % 2 = 0").withColumn("seq", F.lit(1)))
    return updates.merge(rows.unionByName(new.where("page_view_id % 2 = 1").withColumns(none).withColumn("seq", F.lit(1)))).drop("seq")


# ---- state and operations

_CUT = f"j AS (SELECT \"partition\", least(max(CASE WHEN kind = 'c' THEN event_time END), max(CASE WHEN kind = 'v' THEN event_time END)) AS joined FROM e GROUP BY 1)"
_GONE = f"event_time < joined - to_seconds({CFG.lateness + CFG.window})"


@query(f', {_CUT} SELECT id AS click_id, "partition", event_time FROM c JOIN j USING ("partition") WHERE NOT coalesce({_GONE}, false)')
def clicks_retained(spark, d):
    return ops.retained(clicks(spark, d), quality.joined_watermark(events(spark, d)), CFG).select(F.col("id").alias("click_id"), "partition", "event_time")


@query(f', {_CUT} SELECT id AS click_id, "partition", event_time FROM c JOIN j USING ("partition") WHERE {_GONE}')
def clicks_evicted(spark, d):
    return ops.retained(clicks(spark, d), quality.joined_watermark(events(spark, d)), CFG, evicted=True).select(F.col("id").alias("click_id"), "partition", "event_time")


_SIZES = """z AS (SELECT "partition", date_trunc('hour', arr) AS "at", count(*) AS arrived FROM c GROUP BY 1, 2),
y AS (SELECT *, CAST(sum(arrived) OVER (PARTITION BY "partition" ORDER BY "at") AS BIGINT) AS in_total FROM z)"""


def _sizes(spark, d) -> DataFrame:
    return ops.state_sizes(clicks(spark, d)).withColumn("at", F.col("at").cast("timestamp_ntz"))


@query(f", {_SIZES} SELECT * FROM y")
def state_size_over_time(spark, d):
    return _sizes(spark, d)


@query(f""", {_SIZES} SELECT "partition", "at", arrived, coalesce(last_value(CASE WHEN arrived > 2 THEN true WHEN arrived <= 1 THEN false END IGNORE NULLS) OVER (PARTITION BY "partition" ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS paused FROM y""")
def backpressure_hysteresis(spark, d):
    return ops.hysteresis(_sizes(spark, d), "arrived", 2, 1, ["partition"], "at").drop("in_total")


@query(""", b AS (SELECT kind, "offset", user_id % 3 AS p, id % 5 <> 0 AS ok FROM e), n AS (SELECT *, sum(CAST(ok AS INT)) OVER (PARTITION BY kind ORDER BY "offset") AS run FROM b),
m AS (SELECT kind, "offset", CAST(sum(CAST(NOT ok AS INT)) OVER (PARTITION BY kind, run ORDER BY "offset") AS BIGINT) AS failures FROM n) SELECT *, failures >= 1 AS paused FROM m""")
def sink_breaker(spark, d):
    return ops.breaker(events(spark, d).select("kind", "offset", (F.col("id") % 5 != 0).alias("ok")), 1, ["kind"], "offset").drop("ok")


#: Offsets number a topic-partition's events in order; every 10,000th event and that of id 7 aren't done.
@query(""", q AS (SELECT kind AS topic, "partition", "offset", NOT (id % 10000 = 0 OR id = 7) AS done FROM e), o AS (SELECT topic, "partition", min("offset") FILTER (NOT done) AS open FROM q GROUP BY 1, 2)
SELECT topic, "partition", max("offset") + 1 AS next_offset FROM q JOIN o USING (topic, "partition") WHERE done AND (open IS NULL OR "offset" < open) GROUP BY 1, 2""")
def committable_offsets(spark, d):
    done = ~((F.col("id") % 10000 == 0) | (F.col("id") == 7))
    return ops.committable(events(spark, d).select(F.col("kind").alias("topic"), "partition", "offset", done.alias("done")))


@query(f""", {_COPIED} SELECT 'user on several partitions' AS problem, CAST(user_id AS VARCHAR) AS what, count(DISTINCT "partition") AS n FROM d GROUP BY user_id HAVING count(DISTINCT "partition") > 1
UNION ALL SELECT 'partition outside the topology', CAST("partition" AS VARCHAR), count(*) FROM d WHERE "partition" NOT BETWEEN 0 AND 1 GROUP BY "partition" """)
def partition_topology_check(spark, d):
    return ops.topology(_copied(events(spark, d)), Config(partitions=2))


# ---- observability

@query(f""", {SQL_SAID}, av AS (SELECT * FROM s WHERE reason IS NULL AND kind = 'v'), ac AS (SELECT * FROM s WHERE reason IS NULL AND kind = 'c'), a AS ({sql_attribute(3 * HOUR, 'av', 'ac')})
SELECT (SELECT count(*) FROM c) AS clicks_consumed, (SELECT count(*) FROM v) AS views_consumed, (SELECT count(*) FROM a) AS views_attributed, (SELECT count(attributed_click_id) FROM a) AS views_with_click,
  (SELECT count(*) FROM s WHERE reason IS NOT NULL) AS dead_letters""")
def counters_snapshot(spark, d):
    e = quality.classify(events(spark, d), F.col("arr"), CFG)
    return observe.counters(asof.attribute_events(e, 3 * HOUR, every=True))


@query("""SELECT i, bucket, count(t.x) AS n FROM (VALUES (0, '<=1s'), (1, '<=5s'), (2, '<=15s'), (3, '<=60s'), (4, '<=300s'), (5, '>300s')) AS b(i, bucket)
LEFT JOIN (SELECT greatest((event_id * 7919) % 1200 - 5, 0) AS x FROM events WHERE event_type = 'view') AS t
ON i = CASE WHEN x <= 1 THEN 0 WHEN x <= 5 THEN 1 WHEN x <= 15 THEN 2 WHEN x <= 60 THEN 3 WHEN x <= 300 THEN 4 ELSE 5 END GROUP BY 1, 2""")
def latency_histogram(spark, d):
    late = views(spark, d).select((F.timestamp_diff("SECOND", F.col("event_time"), F.col("arr")) - 5).alias("s"))
    return observe.latency_histogram(late, "s")


@query('SELECT kind, id, user_id, event_time FROM e ORDER BY arr DESC, "offset" DESC LIMIT 20')
def recent_events(spark, d):
    return observe.recent(events(spark, d), 20, "arr", "offset").select("kind", "id", "user_id", "event_time")


@query(f", a AS ({sql_attribute(24 * HOUR)}) SELECT page_view_id, attributed_click_id FROM a WHERE attributed_click_id IS NOT NULL ORDER BY event_time DESC, page_view_id DESC LIMIT 20")
def recent_attributions(spark, d):
    a = _attribution(24 * HOUR, "slots")(spark, d).where("attributed_click_id is not null")
    return observe.recent(a, 20, "event_time", "page_view_id").select("page_view_id", "attributed_click_id")


#: The bounded log of 500 ids: the newest of all events, which arrive up to three times, and of attributed views.
@query(f""", {_COPIED}, f AS (SELECT id, (arg_min(ROW(arr, kind, "offset"), ROW(arr, kind, "offset"))) AS f FROM d GROUP BY id), a AS ({sql_attribute(24 * HOUR)}),
g AS (SELECT v.id, ROW(v.arr, v.kind, v."offset") AS f FROM v JOIN a ON v.id = a.page_view_id WHERE a.attributed_click_id IS NOT NULL),
r AS (SELECT 'live' AS ring, id, f, row_number() OVER (ORDER BY f DESC) - 1 AS place FROM f UNION ALL SELECT 'attributed', id, f, row_number() OVER (ORDER BY f DESC) - 1 FROM g)
SELECT ring, id, f[1] AS "at", CAST(place AS INT) AS place FROM r WHERE place < 500""")
def event_log_rings(spark, d):
    e = events(spark, d)
    found = _attribution(24 * HOUR, "slots")(spark, d).where("attributed_click_id is not null").select(F.col("page_view_id").alias("id"))
    return observe.event_log(_copied(e), e.join(found, "id"), 500)


@query("SELECT kind, id, user_id, event_time, campaign_id, url FROM e WHERE id = (SELECT max(event_id) FROM events WHERE event_type IN ('click', 'view'))")
def event_by_id(spark, d):
    e = events(spark, d)
    return observe.by_id(e, e.agg(F.max("id")).first()[0]).select("kind", "id", "user_id", "event_time", "campaign_id", "url")


@query(f""", {_CUT}, a AS (SELECT "partition", kind, min(arr) AS "at" FROM e JOIN j USING ("partition") WHERE event_time >= joined GROUP BY 1, 2), m AS (SELECT "partition", max("at") AS "at" FROM a GROUP BY 1),
h AS (SELECT "partition", count(*) AS n FROM c JOIN j USING ("partition") WHERE NOT coalesce({_GONE}, false) GROUP BY 1)
SELECT p."partition", joined AS joined_watermark, date_sub('second', "at", TIMESTAMP '{NOW}') AS seconds, coalesce(n, 0) AS clicks
FROM (SELECT CAST(unnest(range(5)) AS INT) AS "partition") AS p LEFT JOIN j USING ("partition") LEFT JOIN m USING ("partition") LEFT JOIN h USING ("partition")""")
def dashboard_summary(spark, d):
    return observe.dashboard(events(spark, d), F.lit(NOW).cast("timestamp_ntz"), Config(partitions=5))


_STEPS = f"""{SQL_SAID}, t AS (SELECT id, arr AS "at", 'consumed' AS label FROM s UNION ALL SELECT id, arr, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected: ' || reason END FROM s)"""


@query(f""", {_STEPS} SELECT id, count(*) AS n_steps, string_agg(strftime("at", '%Y-%m-%d %H:%M:%S') || ' ' || label, '; ' ORDER BY "at", label) AS steps FROM t GROUP BY id""")
def event_journey(spark, d):
    s = quality.classify(events(spark, d), F.col("arr"), CFG)
    label = F.coalesce(F.concat(F.lit("rejected: "), "reason"), F.lit("accepted"))
    steps = s.select("id", F.explode(F.array(F.struct(F.col("arr").alias("at"), F.lit("consumed").alias("label")), F.struct(F.col("arr").alias("at"), label.alias("label")))).alias("s")).select("id", "s.*")
    text = F.array_join(F.transform("steps", lambda x: F.concat_ws(" ", F.date_format(x["at"], "yyyy-MM-dd HH:mm:ss"), x["label"])), "; ")
    return observe.journeys(steps).select("id", F.size("steps").cast("long").alias("n_steps"), text.alias("steps"))


@query(f""", m AS (SELECT kind, "partition", max(event_time) AS event_time FROM e GROUP BY 1, 2), a AS (SELECT kind, "partition", min(arr) AS "at" FROM e JOIN m USING (kind, "partition", event_time) GROUP BY 1, 2)
SELECT kind, "partition", date_sub('second', "at", TIMESTAMP '{NOW}') AS seconds FROM a""")
def processing_staleness(spark, d):
    return observe.staleness(events(spark, d), F.lit(NOW).cast("timestamp_ntz"))
