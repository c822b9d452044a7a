"""Rows for tests."""

from datetime import datetime, timedelta

import pandas as pd

BASE = datetime(2024, 1, 1, 12)
EVENT = "kind string, partition int, offset long, arr timestamp, user_id string, event_time timestamp, id string, campaign_id string, url string, value string"


def event(offset, kind, user, minute, name, campaign=None, arr=None, partition=0):
    """An event `minute` minutes after BASE; by default it arrives in order of its offset."""
    t = None if minute is None else BASE + timedelta(minutes=minute)
    return (kind, partition, offset, BASE + timedelta(hours=5, seconds=offset) if arr is None else arr, user, t, name, campaign, "/" + name if kind == "v" else None, f"raw {name}")


#: The golden workload (lateness 15 minutes, one partition, in this order) and what it gives.
GOLDEN = [event(i, *x) for i, x in enumerate([
    ("c", "user_1", 5, "click_1", "campaign_A"), ("v", "user_1", 10, "pv_1"), ("v", "user_2", 15, "pv_2"), ("c", "user_2", 12, "click_2", "campaign_B"),
    ("c", "user_3", 20, "click_3a", "campaign_C"), ("c", "user_3", 25, "click_3b", "campaign_D"), ("v", "user_3", 30, "pv_3"), ("c", "user_4", 35, "click_4", "campaign_E"),
    ("v", "user_4", 70, "pv_4"), ("v", "user_5", 45, "pv_5"), ("v", "user_6", 80, "pv_6"), ("c", "user_advance", 200, "click_advance", "campaign_Z"),
    ("v", "user_advance", 200, "pv_advance"), ("c", "user_5", 40, "click_5", "campaign_F")])]
GOLDEN_ROWS = {"pv_1": ("campaign_A", "click_1"), "pv_2": ("campaign_B", "click_2"), "pv_3": ("campaign_D", "click_3b"), "pv_4": (None, None), "pv_5": (None, None), "pv_6": (None, None)}


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def rows(p):
        return sorted(tuple("NULL" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in p[columns].astype(object).itertuples(index=False))

    assert rows(got) == rows(want)
