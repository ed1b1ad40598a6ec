"""Run dates, local-day windows and time differences."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaptrend.functions.lexicon import LOCAL_ZONE


def as_date(value: str | date | datetime, name: str = "date") -> date:
    """Parse ``YYYY-MM-DD``; anything else is an error that names the parameter."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    try:
        return datetime.strptime(value, "%Y-%m-%d").date()
    except (TypeError, ValueError) as err:
        raise ValueError(f"{name} must be a date or YYYY-MM-DD text, got {value!r}") from err


@dataclass(frozen=True)
class DateWindow:
    """Inclusive range of days."""

    start: date
    end: date

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def dates(self) -> list[str]:
        return [(self.start + timedelta(days=i)).isoformat() for i in range(self.days)]


def date_window(start=None, end=None, latest=None) -> DateWindow:
    """Window from explicit bounds; a bound left out defaults to the latest date."""
    bounds = []
    for name, value in (("start_date", start), ("end_date", end)):
        value = latest if value is None else value
        if value is None:
            raise ValueError(f"{name} or the latest run date is needed")
        bounds.append(as_date(value, name))
    if bounds[1] < bounds[0]:
        raise ValueError(f"end_date {bounds[1]} is before start_date {bounds[0]}")
    return DateWindow(*bounds)


def local_yesterday(now: Column | None = None, zone: str = LOCAL_ZONE) -> Column:
    """Default run date: the day before today in a local zone."""
    now = F.current_timestamp() if now is None else now
    return F.date_sub(F.to_date(F.from_utc_timestamp(now, zone)), 1)


def search_window_utc(run_date: Column, days: int = 3, zone: str = LOCAL_ZONE) -> tuple[Column, Column]:
    """UTC instants of local midnight ``days - 1`` days before, and of the midnight after."""
    first = F.date_sub(run_date, days - 1).cast("timestamp")
    last = F.date_add(run_date, 1).cast("timestamp")
    return F.to_utc_timestamp(first, zone), F.to_utc_timestamp(last, zone)


def days_between_inclusive(start: Column, end: Column) -> Column:
    """Array of every day from ``start`` to ``end``, both included."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def whole_hours(later: Column, earlier: Column) -> Column:
    """Whole hours between two instants, truncated toward zero."""
    return F.timestamp_diff("HOUR", earlier, later)
