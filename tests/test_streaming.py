"""Streams against the batch results: golden workload, restarts, arrival in pieces, append mode."""

import json
import os
import random
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.helpers import BASE, EVENT, GOLDEN, GOLDEN_ROWS, event
from tidemark.config import Config
from tidemark.operators import asof, observe, quality
from tidemark.streaming.append import attribute_stream
from tidemark.streaming.sinks import Table, retry, writer
from tidemark.streaming.supervise import supervise
from tidemark.streaming.update import changes

CFG = Config(lateness=15 * 60)


def put(folder, name, rows):
    """A file of records. Its time follows its number, as files written in one millisecond have no order."""
    os.makedirs(folder, exist_ok=True)
    keys = [f.split()[0] for f in EVENT.split(", ")]
    with open(f"{folder}/.{name}", "w") as f:
        for r in rows:
            f.write(json.dumps(dict(zip(keys, [x.isoformat() + "Z" if hasattr(x, "isoformat") else x for x in r]))) + "\n")
    os.utime(f"{folder}/.{name}", (1_700_000_000 + 10 * int(name.split(".")[0]),) * 2)
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def update_run(spark, tmp, table, cfg=CFG):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    q = changes(stream, cfg).writeStream.foreachBatch(writer(table, f"{tmp}/dead", cfg)).option("checkpointLocation", f"{tmp}/ck").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None


def test_update_mode(spark, tmp_path):
    tmp = str(tmp_path)
    table = Table(spark, f"{tmp}/table", buckets=2)
    put(f"{tmp}/in", "0.json", GOLDEN[:8])
    update_run(spark, tmp, table)
    put(f"{tmp}/in", "1.json", GOLDEN[8:])  # after a restart from the checkpoint
    update_run(spark, tmp, table)
    got = {r.page_view_id: (r.attributed_campaign_id, r.attributed_click_id) for r in table.read().collect() if r.page_view_id != "pv_advance"}
    assert got == GOLDEN_ROWS
    dead = [json.loads(r.value) for r in spark.read.parquet(f"{tmp}/dead/*").collect()]
    assert [(d["payload"], d["reason"]) for d in dead] == [("raw click_5", "event_time before watermark cutoff")]


def test_update_mode_equals_batch(spark, tmp_path):
    rnd, tmp = random.Random(3), str(tmp_path)
    rows = [event(i, rnd.choice("cv"), f"u{rnd.randint(0, 3)}", i / 2 + rnd.randint(-25, 0), f"e{i:03}", f"k{i % 3}", partition=i % 2) for i in range(160)]
    table = Table(spark, f"{tmp}/table", buckets=2)
    for k in range(4):
        part = rows[k * 40 : (k + 1) * 40]
        rnd.shuffle(part)  # within a batch, arrival counts and not the place in a file
        put(f"{tmp}/in", f"{k}.json", part)
    update_run(spark, tmp, table)
    d = quality.classify(spark.createDataFrame(rows, EVENT), F.lit("2025-01-01").cast("timestamp"), CFG)
    ok = d.where("reason is null")
    want = {(r.page_view_id, r.user_id): r.attributed_click_id for r in asof.attribute(ok.where("kind = 'v'"), ok.where("kind = 'c'"), CFG.window).collect()}
    assert {(r.page_view_id, r.user_id): r.attributed_click_id for r in table.read().collect()} == want
    assert spark.read.parquet(f"{tmp}/dead/*").count() == d.where("reason is not null").count() > 0


def test_first_rows_count_once(spark, tmp_path):
    """A corrected view, and one that comes twice, are inserted once, with what they were attributed to at first."""
    tmp = str(tmp_path)
    table = Table(spark, f"{tmp}/table", buckets=2)
    put(f"{tmp}/in", "0.json", [event(0, "c", "a", 5, "old", "OLD"), event(1, "v", "a", 20, "p"), event(2, "c", "a", 10, "new", "NEW"), event(3, "v", "a", 20, "p")])
    put(f"{tmp}/in", "1.json", [event(4, "v", "a", 20, "p"), event(5, "c", "a", 12, "newer", "NEWER"), event(6, "v", "b", 20, "p")])
    update_run(spark, tmp, table)
    assert {(r.page_view_id, r.user_id): r.attributed_campaign_id for r in table.read().collect()} == {("p", "a"): "NEWER", ("p", "b"): None}
    first = table.inserts()
    assert sorted((r.page_view_id, r.user_id, r.attributed_campaign_id) for r in first.collect()) == [("p", "a", "OLD"), ("p", "b", None)]
    assert [tuple(r) for r in observe.campaign_credit(first).collect()] == [("OLD", 1)]


def state_rows(q):
    """Keys in the state of both operators, by the query's progress."""
    return sum(o["numRowsTotal"] for o in json.loads(q.lastProgress.json)["stateOperators"])


def test_state_of_quiet_users_leaves(spark, tmp_path):
    """A thousand users with one click and one view each; once the fence has passed them, only the active one has state."""
    tmp = str(tmp_path)
    rows = [e for i in range(300) for e in (event(2 * i, "c", f"u{i}", 1 + i / 1000, f"c{i}", "k"), event(2 * i + 1, "v", f"u{i}", 2 + i / 1000, f"v{i}"))]
    put(f"{tmp}/in", "0.json", rows)
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    seen = []
    for k in (0, 1, 2):
        if k:
            put(f"{tmp}/in", f"{k}.json", [event(1000 * k + i, kind, "active", 100 * k + i, f"a{k}{i}") for i, kind in enumerate("cvcv")])
        q = changes(stream, CFG).writeStream.foreachBatch(lambda d, b: seen.append(d.where("what = 'row'").count())).option("checkpointLocation", f"{tmp}/ck").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None
        size = state_rows(q)
        if k == 0:
            assert size >= 900 and seen[-1] == 300
    assert size < 20, size


def fence_by_hand(rows, cfg):
    """The late records, one record at a time, with idle topics and a joined watermark that never goes back."""
    marks, arrived, joined, late = {}, {}, None, set()
    for kind, part, off, arr, user, t, *_ in sorted(rows, key=lambda r: (r[3], r[0], r[2])):
        other = "v" if kind == "c" else "c"
        both = min(marks.values()) if len(marks) == 2 else None
        if cfg.idle is not None:
            silent = {k for k, a in arrived.items() if (arr - a).total_seconds() > cfg.idle}
            if len(silent) == 1 and (awake := marks.get("v" if silent == {"c"} else "c")) is not None:
                both = awake if both is None else max(both, awake)
        if both is not None:
            joined = both if joined is None else max(joined, both)
        if joined is not None and t <= joined - timedelta(seconds=cfg.lateness):
            late.add(off)
        else:
            marks[kind] = max(t, marks.get(kind, t))
        arrived[kind] = arr
    return late


@pytest.mark.parametrize("idle", [None, 600])
def test_fence_with_idle_topics(spark, tmp_path, idle):
    """Views pause for a long time, then come back; ties in arrival between topics."""
    tmp, rnd, cfg = str(tmp_path), random.Random(7), Config(lateness=5 * 60, idle=idle)
    rows = []
    for i in range(240):
        kind = "c" if 60 <= i < 150 else rnd.choice("cv")
        rows.append(event(i, kind, f"u{i % 5}", i / 2 + rnd.randint(-20, 0), f"e{i:03}", "k", arr=BASE + timedelta(hours=5, seconds=30 * (i - i % 2))))
    for k in range(4):
        put(f"{tmp}/in", f"{k}.json", rows[k * 60 : (k + 1) * 60])
    update_run(spark, tmp, Table(spark, f"{tmp}/table", buckets=2), cfg)
    got = {json.loads(r.value)["offset"] for r in spark.read.parquet(f"{tmp}/dead/*").collect()}
    assert got == fence_by_hand(rows, cfg) and got
    if idle:
        assert got != fence_by_hand(rows, Config(lateness=5 * 60))


def test_old_manifests_go(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), buckets=4, keep=2)
    columns = "page_view_id string, user_id string, event_time timestamp, url string, attributed_campaign_id string, attributed_click_id string, attributed_click_time timestamp"
    for b in range(6):
        table.upsert(spark.createDataFrame([(f"p{b}", "a", GOLDEN[0][5], "/p", None, None, None)], columns), b)
    assert sorted(r.page_view_id for r in table.read().collect()) == [f"p{b}" for b in range(6)]
    assert table._folders("manifests") == [4, 5] and len(table._folders("rows")) <= 6 and table.inserts().count() == 6
    table.upsert(spark.createDataFrame([("p5", "a", GOLDEN[0][5], "/p", None, None, None)], columns), 5)  # again
    assert table.read().count() == 6 and table.inserts().count() == 6


def test_append_mode(spark, tmp_path):
    tmp = str(tmp_path)
    put(f"{tmp}/in", "0.json", GOLDEN[:11])
    put(f"{tmp}/in", "1.json", [event(20 + i, k, "user_advance", 290 + i, f"a{i}") for i, k in enumerate("cvcv")])
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    q = attribute_stream(stream, CFG).writeStream.format("parquet").option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ck").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = {r.page_view_id: (r.attributed_campaign_id, r.attributed_click_id) for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert {k: got.get(k) for k in GOLDEN_ROWS} == GOLDEN_ROWS


def test_upsert_again_changes_nothing(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), buckets=2)
    schema = "page_view_id string, user_id string, event_time timestamp, url string, attributed_campaign_id string, attributed_click_id string, attributed_click_time timestamp"
    t = GOLDEN[0][5]
    table.upsert(spark.createDataFrame([("p", "a", t, "/p", None, None, None), ("q", "a", t, "/q", "k", "c", t)], schema), 0)
    for _ in range(2):
        table.upsert(spark.createDataFrame([("p", "a", t, "/p", "k", "c", t), ("q", "a", t, "/q", None, None, None)], schema), 1)
    assert sorted((r.page_view_id, r.attributed_click_id) for r in table.read().collect()) == [("p", "c"), ("q", "c")]


def test_supervised_stream(spark, tmp_path):
    """A sink that fails now and then, and for good: the stream goes on from its checkpoint, and rows count once."""
    tmp, waits, fail = str(tmp_path), [], iter([True, True, False, True, False, False])
    table = Table(spark, f"{tmp}/table", buckets=2)
    for k, rows in enumerate((GOLDEN[:5], GOLDEN[5:9], GOLDEN[9:])):
        put(f"{tmp}/in", f"{k}.json", rows)
    write = writer(table, f"{tmp}/dead", CFG)

    def start(broken=False):
        def batch(d, n):
            write(d, n)
            if broken or next(fail):
                raise OSError("after the write")
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
        return changes(stream, CFG).writeStream.foreachBatch(batch).option("checkpointLocation", f"{tmp}/ck").outputMode("append").trigger(availableNow=True).start()
    assert supervise(start, first=1, longest=3, sleep=waits.append) == 3 and waits == [1, 2, 1]
    got = {r.page_view_id: (r.attributed_campaign_id, r.attributed_click_id) for r in table.read().collect() if r.page_view_id != "pv_advance"}
    assert got == GOLDEN_ROWS and table.inserts().count() == 7
    put(f"{tmp}/in", "3.json", [event(50, "v", "user_9", 300, "pv_9")])
    waits.clear()
    with pytest.raises(StreamingQueryException):
        supervise(lambda: start(True), most=3, first=1, longest=1.5, sleep=waits.append)
    assert waits == [1, 1.5]


def test_retry():
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 4:
            raise OSError
    retry(call, first=1, most=3, sleep=waits.append)
    assert waits == [1, 2, 3]
