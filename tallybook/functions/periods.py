"""Reporting windows and local-time buckets."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TORONTO = "America/Toronto"
NTZ = "timestamp_ntz"


#: Marks of a day column: the timestamp column whose day it holds, and the zone of that day.
DAYS_OF, ZONE = "days_of", "zone"


def in_zone(utc: datetime, tz: str) -> datetime:
    """A UTC wall clock in another zone."""
    return utc.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(tz)).replace(tzinfo=None)


def moment(value: datetime | str) -> Column:
    """A zone-free timestamp literal; Catalyst folds it, so it still reaches the scan."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast(NTZ)


def _minus_months(value: datetime, months: int) -> datetime:
    index = value.year * 12 + value.month - 1 - months
    year, month = divmod(index, 12)
    next_month = datetime(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (next_month - timedelta(days=1)).day
    return value.replace(year=year, month=month + 1, day=min(value.day, last_day))


@dataclass(frozen=True)
class ReportWindow:
    """Half-open period [start, end) stated in local wall-clock time."""

    start: datetime
    end: datetime
    tz: str = TORONTO

    @classmethod
    def month(cls, year: int, month: int, tz: str = TORONTO) -> "ReportWindow":
        following = datetime(year + (month == 12), month % 12 + 1, 1)
        return cls(datetime(year, month, 1), following, tz)

    @classmethod
    def day(cls, year: int, month: int, day: int, tz: str = TORONTO) -> "ReportWindow":
        start = datetime(year, month, day)
        return cls(start, start + timedelta(days=1), tz)

    def _utc(self, local: datetime) -> datetime:
        aware = local.replace(tzinfo=ZoneInfo(self.tz))
        return aware.astimezone(timezone.utc).replace(tzinfo=None)

    @property
    def start_utc(self) -> datetime:
        return self._utc(self.start)

    @property
    def end_utc(self) -> datetime:
        return self._utc(self.end)

    def holds_utc(self, col: Column | str, *, months_back: int = 0, days_back: int = 0) -> Column:
        """start - look-back <= col < end, for a UTC column."""
        c = F.col(col) if isinstance(col, str) else col
        low = _minus_months(self.start_utc, months_back) - timedelta(days=days_back)
        return (c >= moment(low)) & (c < moment(self.end_utc))

    def holds_local(self, col: Column | str, *, closed: bool = False) -> Column:
        """start <= col < end for a local column; closed=True also keeps col == end."""
        c = F.col(col) if isinstance(col, str) else col
        upper = c <= moment(self.end) if closed else c < moment(self.end)
        return (c >= moment(self.start)) & upper

    def started_utc(self, col: Column | str) -> Column:
        return (F.col(col) if isinstance(col, str) else col) < moment(self.start_utc)

    def ended_utc(self, col: Column | str) -> Column:
        return (F.col(col) if isinstance(col, str) else col) < moment(self.end_utc)


def in_window(
    df: DataFrame, ts: str, window: ReportWindow | None, *, months_back: int = 0, days_back: int = 0
) -> DataFrame:
    """Keep the rows whose UTC timestamp falls in the window; None keeps all.

    A table whose catalog declares a layout by day carries the day as a column marked so; the same bounds
    are then also stated on it, in the layout's zone, and whole directories are pruned before a file is opened.
    """
    if window is None:
        return df
    kept = df.where(window.holds_utc(ts, months_back=months_back, days_back=days_back))
    for field in df.schema.fields:
        if field.metadata.get(DAYS_OF) == ts:
            low = _minus_months(window.start_utc, months_back) - timedelta(days=days_back)
            first, last = (in_zone(t, field.metadata[ZONE]).date() for t in (low, window.end_utc))
            kept = kept.where(F.col(field.name).between(F.lit(first), F.lit(last)))
    return kept


def to_local(ts: Column | str, tz: str = TORONTO) -> Column:
    """UTC wall clock to local wall clock; in autumn two UTC hours share one local hour.

    In a UTC session the conversion goes through a zoned timestamp, which looks the zone up once
    and is several times cheaper. In any other session zone that detour would bend times in the
    zone's own clock changes, so the zone-free conversion is used.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC"):
        return F.from_utc_timestamp(c.cast("timestamp"), tz).cast(NTZ)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c)


def bucket(ts: Column | str, unit: str) -> Column:
    """Start of the day, month or second, zone-free whatever the session time zone is."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if unit == "day":
        return c.cast("date").cast(NTZ)
    if unit == "month":
        return F.trunc(c.cast("date"), "month").cast(NTZ)
    if unit == "second":
        # the fraction of a second is the same in every zone, so the detour through one is safe
        fraction = F.unix_micros(c.cast("timestamp")) % 1_000_000
        return F.timestamp_add("MICROSECOND", (-F.pmod(fraction, F.lit(1_000_000))).cast("int"), c)
    raise ValueError(f"unknown bucket {unit!r}")


def seconds_between(start: Column, end: Column) -> Column:
    """end - start in seconds, with the fraction kept."""
    return (end - start).cast("interval second").cast("decimal(20,6)")
