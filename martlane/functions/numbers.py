"""Numeric column functions: lenient casts, money, profit metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane import schemas as S

# Leading number of a text, the way a lenient string-to-decimal cast reads it.
LEADING_NUMBER = r"^\s*([+-]?([0-9]+([.][0-9]*)?|[.][0-9]+))"
POSITIVE_NUMBER_TEXT = r"^[0-9]+([.][0-9]+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_decimal(c, precision: int = 12, scale: int = 2) -> Column:
    """Text -> decimal reading the leading number: '12abc' -> 12, 'abc' -> 0, NULL -> NULL;
    a number beyond the type's range becomes the type's bound of that sign.

    A clean number (the common case) is parsed by a plain ``try_cast`` (whitespace trimmed,
    half-up rounding); only text that does not cast goes through the regex for its
    leading number.
    """
    c = _col(c)
    dt = T.DecimalType(precision, scale)
    text = c.cast("string")
    head = F.regexp_extract(text, LEADING_NUMBER, 1)
    wide = F.coalesce(text.try_cast(T.DecimalType(38, scale)), head.try_cast(T.DecimalType(38, scale)),
                      F.when(head.startswith("-"), -bound(dt)).when(head != "", bound(dt)), F.lit(0))
    # ``wide`` is never NULL here and has the scale: it only has to be kept within the range
    parsed = F.coalesce(text.try_cast(dt), F.greatest(F.least(wide, bound(dt)), -bound(dt)).cast(dt))
    return F.when(c.isNull(), F.lit(None).cast(dt)).otherwise(parsed)


def bound(dt: T.DecimalType) -> Column:
    """The largest value of a decimal type."""
    digits = "9" * dt.precision
    return F.lit(f"{digits[:dt.precision - dt.scale]}.{digits[:dt.scale]}").cast(dt)


def clamped(c, dt: T.DecimalType) -> Column:
    """Round to the type's scale and keep within its range, where a cast would fail.

    A number that fits (the common case) is worked out once, by the cast, which rounds half up
    as well.
    """
    c = _col(c)
    # a NULL compares as neither and stays one
    return F.coalesce(c.try_cast(dt), F.when(c > 0, bound(dt)).when(c < 0, -bound(dt)))


def lenient_int(c) -> Column:
    """Text -> INT column value: the leading number, rounded half up, within the INT range."""
    whole = F.round(lenient_decimal(c, 18, 4), 0).cast("bigint")
    return F.when(whole.isNotNull(), F.greatest(F.least(whole, F.lit((1 << 31) - 1)), F.lit(-1 << 31))).cast("int")


def positive_number_text(c) -> Column:
    """Digits with an optional literal-dot fraction, and > 0."""
    c = _col(c)
    return c.rlike(POSITIVE_NUMBER_TEXT) & (c.try_cast(S.MONEY4) > 0)


def safe_ratio(num, den, scale: int = 2) -> Column:
    """round(num / den, scale) when den > 0, else 0."""
    num, den = _col(num), _col(den)
    ratio = (num / den).cast(T.DecimalType(38, 6))
    return clamped(F.when(den > 0, F.round(ratio, scale)).otherwise(F.lit(0)), S.MONEY)


def net_revenue(gross, discount, refunded) -> Column:
    """gross - discount + refunded (the refund is added, as the source does)."""
    return clamped(_revenue_raw(gross, discount, refunded), S.MONEY)


def _revenue_raw(gross, discount, refunded) -> Column:
    return _col(gross) - _col(discount) + _col(refunded)


def _costs(cogs, logistics, ads, other) -> Column:
    return _col(cogs) + _col(logistics) + _col(ads) + _col(other)


def net_profit(gross, discount, refunded, cogs, logistics, ads, other) -> Column:
    rev = _revenue_raw(gross, discount, refunded)
    return clamped(rev - _costs(cogs, logistics, ads, other), S.MONEY)


def net_margin(gross, discount, refunded, cogs, logistics, ads, other) -> Column:
    """Profit / revenue in percent, clamped to +-9999.99; 0 when revenue <= 0."""
    rev = _revenue_raw(gross, discount, refunded)
    profit = rev - _costs(cogs, logistics, ads, other)
    ratio = (profit / rev).cast(T.DecimalType(32, 6))
    pct = F.round(ratio * 100, 2)
    bound = F.lit(S.MARGIN_BOUND).cast(S.MARGIN)
    clamped = F.greatest(F.least(pct, bound), -bound)
    return F.when(rev > 0, clamped).otherwise(F.lit(0)).cast(S.MARGIN)
