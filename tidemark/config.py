"""Settings of the attribution engine."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Lengths of time in seconds. window: how long a click counts; lateness: how far behind the joined watermark an
    event may be; skew: how far ahead of the clock; idle: after how long without a record a topic of a partition holds the
    stream's joined watermark no longer (None: it always does); sweep: how far the watermark moves between sweeps of the
    users whose state may leave."""

    window: int = 30 * 60
    lateness: int = 2 * 60
    skew: int = 5 * 60
    partitions: int = 3
    click_topic: str = "ad_clicks"
    view_topic: str = "page_views"
    idle: int | None = None
    sweep: int = 60

    def __post_init__(self) -> None:
        if not 0 <= self.lateness <= 15 * 60:
            raise ValueError("lateness must be from 0 to 15 minutes")
        if self.window <= 0 or self.skew < 0 or self.partitions < 1:
            raise ValueError("window and partitions must be positive, skew not negative")
        if self.sweep < 0 or (self.idle is not None and self.idle <= 0):
            raise ValueError("idle must be positive, sweep not negative")
