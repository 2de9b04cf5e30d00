"""Local-time expressions and the processing windows of the jobs.

No function here reads the clock: the caller passes the instant, so a re-run
files its rows where the first run did.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Tokyo"


@dataclass(frozen=True)
class HourWindow:
    """One hour of local time; the single source of path, stamp and filters."""

    start: datetime
    zone: str = LOCAL_ZONE

    def __post_init__(self):
        if self.start.tzinfo is None:
            raise ValueError("the window start needs a time zone")

    @property
    def local_start(self) -> datetime:
        return self.start.astimezone(ZoneInfo(self.zone)).replace(
            minute=0, second=0, microsecond=0
        )

    @property
    def end(self) -> datetime:
        return self.local_start + timedelta(hours=1)

    @property
    def day(self) -> str:
        return self.local_start.strftime("%Y-%m-%d")

    @property
    def hour(self) -> str:
        """Two digits, as in the raw-zone path."""
        return self.local_start.strftime("%H")


def previous_hour(now: datetime, zone: str = LOCAL_ZONE) -> HourWindow:
    """The hour that a run at ``now`` has to fetch."""
    return HourWindow(now - timedelta(hours=1), zone)


def previous_day(now: datetime, zone: str = LOCAL_ZONE) -> str:
    """The local date that a run at ``now`` has to turn into a mart."""
    if now.tzinfo is None:
        raise ValueError("the instant needs a time zone")
    return (now.astimezone(ZoneInfo(zone)) - timedelta(days=1)).strftime("%Y-%m-%d")


def local_time(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(instant, zone)


def local_day(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_time(instant, zone))


def local_hour(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """Hour of day as text without padding: ``"4"``, not ``"04"``."""
    return F.hour(local_time(instant, zone)).cast("string")


def snapshot_day(epoch: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local date before the one in which the epoch second falls.

    A rate snapshot is taken the day after the sales it applies to.
    """
    day = F.date_sub(local_day(F.timestamp_seconds(epoch), zone), 1)
    return F.date_format(day, "yyyy-MM-dd")
