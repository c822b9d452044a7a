"""Update mode: a row for each view at once, corrected as clicks come, and dead letters for all that is rejected.

Two stateful operators in a chain. Fence, keyed by source partition, puts a batch's records in order of arrival (time, topic,
offset), applies the chain of reasons against the partition's joined watermark as it stands before each record, and then
moves it: the reference semantics record by record. The joined watermark is the smaller of both topics' and never goes
back; where a topic is idle (see Config.idle) the other one's counts alone, until a record of it arrives. Attribute, keyed
by user, keeps clicks and views and emits a view's row when it comes and again when a click changes it.

State leaves when the fence has passed it: a click after lateness and window, a view after lateness. Fence knows the
latest time of each user that may have state, and sends a tick to those that the fence has passed, so state of users
without new records leaves too.

Neither drops late records, since no event-time watermark is declared; state is in RocksDB and survives restarts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import Config
from ..operators.quality import outside, structural, too_far_ahead

_EVENT = ["kind", "partition", "offset", "arr", "user_id", "event_time", "id", "campaign_id", "url", "value"]
FENCED = "kind string, partition int, offset long, arr timestamp, user_id string, event_time timestamp, id string, campaign_id string, url string, value string, reason string, fence timestamp"
#: step: the place of a change among those of its user in the batch.
CHANGED = ("what string, kind string, partition int, offset long, value string, reason string, page_view_id string, user_id string, event_time timestamp, url string, "
           "attributed_campaign_id string, attributed_click_id string, attributed_click_time timestamp, step int")
#: No time yet.
NEVER = np.iinfo(np.int64).min


def _time(x) -> datetime | None:
    return None if x is None or pd.isna(x) else pd.Timestamp(x).to_pydatetime()


def _micros(times: pd.Series) -> np.ndarray:
    out = pd.to_datetime(times).astype("datetime64[us]")
    return np.where(out.isna(), NEVER, out.to_numpy().astype(np.int64))


def _before(old: int, values: np.ndarray) -> np.ndarray:
    """The greatest value before each place, and at last that of all."""
    return np.maximum.accumulate(np.concatenate([[old], values]))


class Fence(StatefulProcessor):
    def __init__(self, cfg: Config):
        self.cfg = cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        """marks: watermarks, last arrivals (microseconds) of clicks and views; the joined watermark; that of the last sweep."""
        self.marks = handle.getValueState("marks", "c long, v long, arr_c long, arr_v long, joined long, swept long")
        self.users = handle.getMapState("users", "user string", "t long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["arr", "kind", "offset"], kind="stable", ignore_index=True)
        c, v, arr_c, arr_v, joined, swept = self.marks.get() if self.marks.exists() else (NEVER,) * 6
        time, arr, ok = _micros(d["event_time"]), _micros(d["arr"]), d["reason"].isna().to_numpy()
        click = (d["kind"] == "c").to_numpy()
        # late records are below the watermark, so they can't raise it and needn't be told apart
        marks = [_before(old, np.where(ok & own, time, NEVER)) for old, own in ((c, click), (v, ~click))]
        arrivals = [_before(old, np.where(own, arr, NEVER)) for old, own in ((arr_c, click), (arr_v, ~click))]
        both = np.where((marks[0] > NEVER) & (marks[1] > NEVER), np.minimum(*marks), NEVER)
        if self.cfg.idle is not None:
            now, most = np.append(arr, arr[-1]), self.cfg.idle * 1_000_000
            silent = [(a > NEVER) & (now - np.where(a > NEVER, a, now) > most) for a in arrivals]
            both = np.where(silent[0] & ~silent[1], np.maximum(both, marks[1]), np.where(silent[1] & ~silent[0], np.maximum(both, marks[0]), both))
        both = np.maximum.accumulate(np.maximum(both, joined))
        late = ok & (both[:-1] > NEVER) & (time <= both[:-1] - self.cfg.lateness * 1_000_000)
        joined = int(both[-1])
        accepted = ok & ~late
        for user, t in d.assign(t=time)[accepted].groupby("user_id")["t"].max().items():
            have = self.users.getValue((user,)) if self.users.containsKey((user,)) else None
            if have is None or have[0] < t:
                self.users.updateValue((user,), (int(t),))
        gone: list[str] = []
        if joined > NEVER and (swept == NEVER or joined - swept >= self.cfg.sweep * 1_000_000):
            least, swept = joined - (self.cfg.lateness + self.cfg.window) * 1_000_000, joined
            gone = [k[0] for k, t in self.users.iterator() if t[0] < least]
            for user in gone:
                self.users.removeKey((user,))
        self.marks.update((int(marks[0][-1]), int(marks[1][-1]), int(arrivals[0][-1]), int(arrivals[1][-1]), joined, swept))
        fence = lambda x: pd.Series(pd.to_datetime(np.where(x > NEVER, x, 0), unit="us")).where(x > NEVER)
        reason = [("event_time before watermark cutoff" if x else None) if y else r for r, x, y in zip(d["reason"], late, ok)]
        yield d.assign(reason=pd.Series(reason, dtype=object), fence=fence(both[:-1]).to_numpy())
        if gone:
            none = pd.Series([None] * len(gone), dtype=object)
            never = pd.Series(pd.NaT, index=none.index, dtype="datetime64[ns]")
            ticks = {c: never if c in ("arr", "event_time") else none for c in d.columns}
            yield pd.DataFrame({**ticks, "kind": "t", "partition": key[0], "offset": 0, "user_id": pd.Series(gone, dtype=object), "fence": fence(np.full(len(gone), joined)).to_numpy()})

    def close(self) -> None:
        pass


class Attribute(StatefulProcessor):
    def __init__(self, cfg: Config):
        self.window, self.lateness = timedelta(seconds=cfg.window), timedelta(seconds=cfg.lateness)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clicks = handle.getMapState("clicks", "t timestamp, id string", "campaign string")
        self.views = handle.getMapState("views", "id string", "t timestamp, url string, click_t timestamp, click_id string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["arr", "kind", "offset"], kind="stable", ignore_index=True)
        clicks = {(_time(k[0]), k[1]): v[0] for k, v in self.clicks.iterator()}
        views = {k[0]: [_time(v[0]), v[1], _time(v[2]), v[3]] for k, v in self.views.iterator()}
        # in order, so that a view finds its click, and a click the views of its window, without looking at the others
        in_order, by_time = sorted(clicks), sorted((v[0], i) for i, v in views.items())
        out, fence = [], None
        user = key[0]

        def emit(i: str) -> None:
            t, url, ct, ci = views[i]
            self.views.updateValue((i,), (t, url, ct, ci))
            out.append(("row", None, None, None, None, None, i, user, t, url, clicks.get((ct, ci)), ci, ct, len(out)))

        for r in d.itertuples(index=False):
            if r.reason is not None and not pd.isna(r.reason):
                out.append(("dead_letter", r.kind, r.partition, r.offset, r.value, r.reason, None, user, None, None, None, None, None, len(out)))
                continue
            now = _time(r.fence)
            fence = now if fence is None or (now is not None and now > fence) else fence
            if r.kind == "t":
                continue
            t = _time(r.event_time)
            if r.kind == "c":
                if (t, r.id) not in clicks:  # the first copy wins
                    clicks[t, r.id] = r.campaign_id
                    insort(in_order, (t, r.id))
                    self.clicks.updateValue((t, r.id), (r.campaign_id,))
                    for _, i in by_time[bisect_left(by_time, (t, "")) : bisect_left(by_time, (t + self.window + timedelta(microseconds=1), ""))]:
                        v = views[i]
                        if v[2] is None or (t, r.id) > (v[2], v[3]):
                            v[2], v[3] = t, r.id
                            emit(i)
            else:
                at = bisect_left(in_order, (t + timedelta(microseconds=1), "")) - 1
                best = in_order[at] if at >= 0 and in_order[at][0] >= t - self.window else (None, None)
                have = views.get(r.id)
                if have is None or (best[0] is not None and (have[2] is None or best >= (have[2], have[3]))):
                    if have is not None:
                        del by_time[bisect_right(by_time, (have[0], r.id)) - 1]
                    insort(by_time, (t, r.id))
                    views[r.id] = [t, r.url, *best]
                    emit(r.id)
        if fence is not None:
            for k in in_order[: bisect_left(in_order, (fence - self.lateness - self.window, ""))]:
                self.clicks.removeKey(k)
            for _, i in by_time[: bisect_left(by_time, (fence - self.lateness + timedelta(microseconds=1), ""))]:
                self.views.removeKey((i,))
        p = pd.DataFrame(out, columns=[f.split()[0] for f in CHANGED.split(", ")])
        for c in ("event_time", "attributed_click_time"):
            p[c] = pd.to_datetime(p[c])
        yield p.astype({"partition": "Int32", "offset": "Int64", "step": "int32"})

    def close(self) -> None:
        pass


def changes(events: DataFrame, cfg: Config = Config()) -> DataFrame:
    """events: a stream of parsed events (see sources.parse). A stream of rows (what = row) and dead letters
    (what = dead_letter), for one foreachBatch that writes both (see sinks.Table)."""
    failed = F.col("failed") if "failed" in events.columns else F.lit(None).cast("string")
    first = F.coalesce(failed, outside(cfg), structural(), F.when(too_far_ahead(F.col("arr"), cfg), "event_time too far in future"))
    d = events.select(*_EVENT).withColumn("reason", first) if "failed" not in events.columns else events.select(*_EVENT, "failed").withColumn("reason", first).drop("failed")
    fenced = d.groupBy("partition").transformWithStateInPandas(Fence(cfg), FENCED, "Append", "None")
    return fenced.groupBy("user_id").transformWithStateInPandas(Attribute(cfg), CHANGED, "Append", "None")
