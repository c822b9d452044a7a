"""The reference workloads: golden output, boundaries, duplicates, validation, operations."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import BASE, EVENT, GOLDEN, GOLDEN_ROWS, event
from tidemark.config import Config
from tidemark.functions import bad_timestamp, lenient_timestamp
from tidemark.operators import asof, dedup, observe, ops, quality, updates
from tidemark.schema import ATTRIBUTED, RAW, create_attributed
from tidemark.sources import parse

CFG = Config(lateness=15 * 60)


def frames(spark, rows):
    d = spark.createDataFrame(rows, EVENT)
    return d.where("kind = 'v'"), d.where("kind = 'c'")


def attributed(spark, rows, strategy="slots"):
    return {r.page_view_id: r.attributed_click_id for r in asof.attribute(*frames(spark, rows), 30 * 60, strategy).collect()}


def test_golden(spark):
    d = quality.classify(spark.createDataFrame(GOLDEN, EVENT), F.lit("2024-01-02").cast("timestamp"), CFG)
    ok = d.where("reason is null")
    got = {r.page_view_id: (r.attributed_campaign_id, r.attributed_click_id) for r in asof.attribute(ok.where("kind = 'v'"), ok.where("kind = 'c'"), CFG.window).collect()}
    assert {k: v for k, v in got.items() if k != "pv_advance"} == GOLDEN_ROWS
    assert [r.id for r in d.where("reason is not null").collect()] == ["click_5"]
    letter = quality.dead_letters(d).first()
    assert (letter.key, letter.reason) == ("ad_clicks:0:13", "event_time before watermark cutoff")


@pytest.mark.parametrize("strategy", ["slots", "user", "range"])
def test_bounds_and_ties(spark, strategy):
    rows = [event(0, "c", "a", 0, "x"), event(1, "v", "a", 0, "same"), event(2, "v", "a", 30, "edge"), event(3, "v", "a", 30.1, "past"), event(4, "c", "b", 10, "A"), event(5, "c", "b", 10, "B"),
            event(6, "c", "b", 0, "old"), event(7, "v", "b", 10, "tie"), event(8, "v", "c", 5, "shared"), event(9, "v", "d", 5, "none")]
    assert attributed(spark, rows, strategy) == {"same": "x", "edge": "x", "past": None, "tie": "B", "shared": None, "none": None}


def test_strategies_agree_with_brute_force(spark):
    rnd = random.Random(5)
    rows = [event(i, rnd.choice("cv"), f"u{rnd.randint(0, 6)}", rnd.randint(0, 240), f"e{i:03}", "k") for i in range(400)]
    want = {}
    for v in (r for r in rows if r[0] == "v"):
        near = [(c[5], c[6]) for c in rows if c[0] == "c" and c[4] == v[4] and v[5] - timedelta(minutes=30) <= c[5] <= v[5]]
        want[v[6]] = max(near)[1] if near else None
    for strategy in ("slots", "user", "range"):
        assert attributed(spark, rows, strategy) == want


def late_by_hand(rows, lateness):
    return {r[2] for r in late_rows(rows, lateness)}


def late_rows(rows, lateness):
    """The late rows, by going through the events one at a time."""
    marks, late = {}, []
    for row in sorted(rows, key=lambda r: (r[3], r[0], r[2])):
        kind, part, t = row[0], row[1], row[5]
        c, v = marks.get((part, "c")), marks.get((part, "v"))
        if c and v and t <= min(c, v) - timedelta(seconds=lateness):
            late.append(row)
        else:
            marks[part, kind] = max(t, marks.get((part, kind)) or t)
    return late


def test_lateness_record_by_record(spark):
    rnd = random.Random(9)
    rows = [event(i, rnd.choice("cv"), f"u{rnd.randint(0, 4)}", i / 3 + rnd.randint(-40, 0), f"e{i}", arr=BASE + timedelta(hours=6, minutes=i * rnd.choice([0.2, 7])), partition=i % 2) for i in range(500)]
    got = quality.classify(spark.createDataFrame(rows, EVENT), F.lit("2025-01-01").cast("timestamp"), CFG).where("reason is not null")
    want = late_by_hand(rows, CFG.lateness)
    assert {r.offset for r in got.collect()} == want and want


def test_one_order_of_arrival(spark):
    """Records of both topics with equal arrival times: clicks first, then by offset, wherever order counts."""
    rnd = random.Random(4)
    rows = [event(i // 2 if i % 2 else 200 - i // 2, "cv"[i % 2], f"u{rnd.randint(0, 2)}", i / 3 + rnd.randint(-40, 0), f"e{i}", arr=BASE + timedelta(hours=6, seconds=i // 8)) for i in range(300)]
    got = quality.classify(spark.createDataFrame(rows, EVENT), F.lit("2025-01-01").cast("timestamp"), CFG).where("reason is not null")
    assert {r.offset for r in got.where("kind = 'c'").collect()} | {-1 - r.offset for r in got.where("kind = 'v'").collect()} == {
        r[2] if r[0] == "c" else -1 - r[2] for r in late_rows(rows, CFG.lateness)}
    v, c = frames(spark, [event(5, "v", "a", 20, "p", arr=BASE), event(9, "c", "a", 10, "k", "K", arr=BASE)])
    assert [r.attributed_click_id for r in asof.attribute_initially(v, c, 1800).collect()] == ["k"]


def test_ids_are_compared_as_strings(spark):
    rows = [(kind, 0, i, BASE, 1, BASE, n, "k", "/", "") for i, (kind, n) in enumerate([("c", 9), ("c", 10), ("v", 1)])]
    d = spark.createDataFrame(rows, EVENT.replace("user_id string", "user_id long").replace(" id string", " id long"))
    for strategy in ("slots", "user", "range"):
        assert [r.attributed_click_id for r in asof.attribute(d.where("kind = 'v'"), d.where("kind = 'c'"), 1800, strategy).collect()] == [9]


@pytest.mark.parametrize("slot", [1, 7, 1000])
def test_breaker_over_slots(spark, slot):
    rnd = random.Random(slot)
    rows = [(k, 3 * i, rnd.random() < 0.15) for k in range(3) for i in range(200)]
    want, run = {}, {}
    for k, i, ok in rows:
        run[k] = 0 if ok else run.get(k, 0) + 1
        want[k, i] = (run[k], run[k] >= 4)
    got = ops.breaker(spark.createDataFrame(rows, "k int, i int, ok boolean"), 4, ["k"], "i", slot).collect()
    assert {(r.k, r.i): (r.failures, r.paused) for r in got} == want


def test_counters_count_inserts_once(spark):
    rows = [("c", "x", "u", None, None), ("v", "p", "u", None, "x"), ("v", "p", "u", None, "x"), ("v", "p", "w", None, None), ("v", "q", "u", "too late", None), ("c", None, None, "missing user_id", None)]
    got = observe.counters(spark.createDataFrame(rows, "kind string, id string, user_id string, reason string, attributed_click_id string")).first()
    assert tuple(got) == (2, 4, 2, 1, 2)
    assert tuple(observe.counters(spark.createDataFrame([], "kind string, id string, user_id string, reason string, attributed_click_id string")).first()) == (0, 0, 0, 0, 0)


def test_event_log_rings(spark):
    """Consumption can't evict attributed ids; a repeated id keeps its place."""
    e = [(f"e{i}", BASE + timedelta(seconds=i), "c", i) for i in range(30)] + [("e27", BASE + timedelta(seconds=99), "c", 99)]
    d = spark.createDataFrame(e, "id string, arr timestamp, kind string, offset long")
    got = observe.event_log(d, d.where("id in ('e1', 'e2', 'e3', 'e4')"), 3).orderBy("ring", "place").collect()
    assert [(r.ring, r.id, r.place) for r in got] == [*(("attributed", f"e{4 - k}", k) for k in range(3)), *(("live", f"e{29 - k}", k) for k in range(3))]


def test_validation(spark):
    ahead = BASE + timedelta(days=1)
    rows = [event(0, "v", "a", None, "x"), event(1, "c", None, 1, "y"), event(2, "c", " \t", 1, "z"), event(3, "v", "a", 24 * 60, "far"), event(4, "v", "a", 5, "ok")]
    d = quality.classify(spark.createDataFrame(rows, EVENT), F.lit(BASE).cast("timestamp"), CFG)
    assert {r.id: r.reason for r in d.collect()} == {"x": "missing event_time", "y": "missing user_id", "z": "missing user_id", "far": "event_time too far in future", "ok": None}
    assert ahead > BASE


def test_times(spark):
    good = {"2024-01-01T12:05:00": "2024-01-01 12:05:00", "2024-01-01T12:05:00Z": "2024-01-01 12:05:00", "2024-01-01T12:05:00.987Z": "2024-01-01 12:05:00", "2024-01-01T14:05:00+02:00": "2024-01-01 12:05:00", " 2024-01-01T12:05 ": "2024-01-01 12:05:00"}
    rows = [(t, want, False) for t, want in good.items()] + [(t, None, True) for t in ("2024", "2024-01-01", "2024-01-01 12:05:00", "2024-13-01T00:00:00", "x")] + [(t, None, False) for t in (None, "", "  ")]
    d = spark.createDataFrame(rows, "t string, want string, bad boolean").select("*", lenient_timestamp(F.col("t")).cast("string").alias("got"), bad_timestamp(F.col("t")).alias("is_bad"))
    assert all(r.got == r.want and r.is_bad == r.bad for r in d.collect())


def test_parse(spark):
    ok = '{"user_id":"u","event_time":"2024-01-01T12:00:00Z","campaign_id":"k","click_id":"c"}'
    cases = [("ad_clicks", 0, ok, None), ("ad_clicks", 0, "{not valid json", "ad_click parse failed"), ("ad_clicks", 0, ok[:-1] + ',"more":1}', "ad_click parse failed"), ("page_views", 1, ok, "page_view parse failed"),
             ("page_views", 2, '{"user_id":5,"event_id":"p"}', None), ("page_views", 5, "{}", "partition outside the topology"), ("other", 0, "{}", "unknown topic"), ("ad_clicks", 0, None, "ad_click parse failed")]
    raw = spark.createDataFrame([(t, p, i, v, BASE) for i, (t, p, v, _) in enumerate(cases)], RAW)
    got = {r.offset: r for r in parse(raw).collect()}
    assert [got[i].failed for i in range(len(cases))] == [c[3] for c in cases]
    assert got[0].id == "c" and got[4].user_id == "5" and got[4].event_time is None


def test_duplicates_and_merge(spark):
    rows = [event(0, "c", "a", 5, "k", "first"), event(1, "c", "a", 5, "k", "second"), event(2, "c", "a", 6, "k", "other"), event(3, "v", "a", 7, "p"), event(4, "v", "b", 7, "p"), event(5, "v", "a", 7, "p")]
    v, c = frames(spark, rows)
    assert sorted((r.event_time.minute, r.campaign_id) for r in dedup.clicks(c).collect()) == [(5, "first"), (6, "other")]
    assert dedup.views(v).count() == 2
    assert [r.offset for r in dedup.copies_from_elsewhere(c, ["user_id", "event_time", "id"]).collect()] == [1]
    t = lambda m: BASE + timedelta(minutes=m)
    d = spark.createDataFrame([("p", "a", None, None, 0), ("p", "a", t(5), "x", 1), ("p", "a", t(4), "y", 2), ("q", "a", t(5), "x", 0), ("q", "a", None, None, 1)],
                              "page_view_id string, user_id string, attributed_click_time timestamp, attributed_click_id string, seq long")
    assert {r.page_view_id: r.attributed_click_id for r in updates.merge(d).collect()} == {"p": "x", "q": "x"}


def test_credit_is_initial(spark):
    rows = [event(0, "c", "a", 5, "old", "OLD"), event(1, "v", "a", 20, "p"), event(2, "c", "a", 10, "new", "NEW")]
    v, c = frames(spark, rows)
    first, last = asof.attribute_initially(v, c, 1800), asof.attribute(v, c, 1800)
    assert [tuple(r) for r in observe.campaign_credit(first).collect()] == [("OLD", 1)]
    assert [(r.initial_click_id, r.attributed_click_id) for r in updates.corrections(first, last).collect()] == [("old", "new")]


def test_operations(spark):
    done = spark.createDataFrame([("t", 0, i, i != 2) for i in range(4)] + [("u", 0, 0, False), ("u", 0, 1, True)] + [("w", 0, i, True) for i in range(4)], "topic string, partition int, offset long, done boolean")
    assert {r.topic: r.next_offset for r in ops.committable(done).collect()} == {"t": 2, "w": 4}
    sizes = spark.createDataFrame([(0, i, n) for i, n in enumerate([101, 60, 50, 70])], "p int, i int, n int")
    assert [r.paused for r in ops.hysteresis(sizes, "n", 100, 50, ["p"], "i").orderBy("i").collect()] == [True, True, False, False]
    calls = spark.createDataFrame([(0, i, ok) for i, ok in enumerate([False, False, True, False, False, False])], "p int, i int, ok boolean")
    assert [r.paused for r in ops.breaker(calls, 3, ["p"], "i").orderBy("i").collect()] == [False] * 5 + [True]
    late = spark.createDataFrame([(0.4,), (1.0,), (3.0,), (45.0,), (600.0,), (-7.0,)], "s double")
    assert [r.n for r in observe.latency_histogram(late, "s").orderBy("i").collect()] == [3, 1, 0, 1, 0, 1]
    credit = spark.createDataFrame([("A", 5), ("B", 3), ("C", 1)], "attributed_campaign_id string, credit long")
    assert [r[0] for r in observe.top(credit, 2).collect()] == ["A", "B"] and observe.top(credit, -1).count() == 0
    e = spark.createDataFrame([event(0, "c", "a", 30, "x"), event(1, "v", "a", 0, "y"), event(2, "c", "a", 30, "z", partition=1)], EVENT)
    marks = {r.partition: r.joined_watermark for r in quality.joined_watermark(e).collect()}
    assert marks == {0: BASE, 1: None}
    assert {r.partition: r.joined_watermark for r in quality.joined_watermark(e, idle="v").collect()}[1] == BASE + timedelta(minutes=30)


def test_partitions_outside_the_topology(spark):
    rows = [event(0, "c", "a", 30, "x"), event(1, "v", "a", 31, "y", partition=5)]
    got = quality.classify(spark.createDataFrame(rows, EVENT), F.lit("2025-01-01").cast("timestamp"), CFG)
    assert {r.id: r.reason for r in got.collect()} == {"x": None, "y": "partition outside the topology"}


def test_table_is_created_once(spark):
    for _ in range(2):
        create_attributed(spark, "made_by_test")
    try:
        assert spark.table("made_by_test").columns == [c.split()[0] for c in ATTRIBUTED.split(", ")] + ["written_at"] and spark.table("made_by_test").count() == 0
    finally:
        spark.sql("DROP TABLE made_by_test")


def test_config():
    with pytest.raises(ValueError):
        Config(lateness=16 * 60)
    with pytest.raises(ValueError):
        ops.hysteresis(None, "n", 1, 2, [], "i")
