"""Date/time column functions and the incremental-window planner of the ads ingest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane import schemas as S

DATETIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2})?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_datetime(c) -> Column:
    """NULL / blank / zero-date / junk -> NULL; 'YYYY-MM-DD[ HH:MM:SS]' -> timestamp_ntz."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(DATETIME_TEXT), text.try_cast(T.TimestampNTZType()))


def plan_ads_window(ads: DataFrame | None, today: dt.date,
                    lookback_days: int = S.ADS_LOOKBACK_DAYS,
                    stop_col: str = "date_stop") -> tuple[dt.date, dt.date]:
    """(since, until) of the next incremental ads load.

    No data, or a high-water mark at/after today -> today - lookback; else mark + 1 day.
    One aggregate value reaches the driver.
    """
    last = None
    if ads is not None:
        last = ads.agg(F.max(F.col(stop_col).cast("date")).alias("m")).first()["m"]
    if last is None or last >= today:
        since = today - dt.timedelta(days=lookback_days)
    else:
        since = last + dt.timedelta(days=1)
    return since, today


def _add_month_clipped(d: dt.date) -> dt.date:
    y, m = (d.year + (d.month // 12), d.month % 12 + 1)
    import calendar
    last = calendar.monthrange(y, m)[1]
    return dt.date(y, m, min(d.day, last))


def month_chunks(since: dt.date, until: dt.date) -> list[tuple[dt.date, dt.date]]:
    """Tile [since, until] with chunks start .. start + 1 month - 1 day (clipped to until)."""
    out = []
    start = since
    while start <= until:
        end = min(_add_month_clipped(start) - dt.timedelta(days=1), until)
        out.append((start, end))
        start = end + dt.timedelta(days=1)
    return out
