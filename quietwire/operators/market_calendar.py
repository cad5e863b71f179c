"""Trading days. The holiday list is a short constant, so it is part of the expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quietwire.settings import HOLIDAYS, MARKET_CLOSE_HOUR, MARKET_ZONE

_DAYS_BACK = 10


def is_trading_day(day: Column, holidays: Iterable[str] = HOLIDAYS) -> Column:
    closed = [F.lit(h).cast("date") for h in holidays]
    weekday = F.weekday(day) < 5
    return weekday & ~day.isin(closed) if closed else weekday


def latest_trading_day(day: Column, holidays: Iterable[str] = HOLIDAYS) -> Column:
    """The day itself or the nearest trading day before it; fails if ten days hold none."""
    days = F.transform(F.sequence(F.lit(0), F.lit(_DAYS_BACK - 1)), lambda back: F.date_sub(day, back))
    open_days = F.filter(days, lambda d: is_trading_day(d, holidays))
    found = F.get(open_days, F.lit(0))
    none_found = F.raise_error(F.lit(f"no trading day found in the last {_DAYS_BACK} days")).cast("date")
    return F.when(day.isNull(), F.lit(None).cast("date")).otherwise(F.coalesce(found, none_found))


def last_closed_session(instant: Column, holidays: Iterable[str] = HOLIDAYS) -> Column:
    """The trading day a run at ``instant`` (UTC) digests: today only once its session is over."""
    local = F.from_utc_timestamp(instant, MARKET_ZONE)
    before_close = (F.hour(local) < MARKET_CLOSE_HOUR).cast("int")
    return latest_trading_day(F.date_sub(F.to_date(local), before_close), holidays)
