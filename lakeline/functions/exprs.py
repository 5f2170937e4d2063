"""Column expressions shared by the layers.

All of them are built-in Spark functions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from lakeline.functions import fixed

# Money is carried as DECIMAL so sums are exact and engine-independent.
MONEY = "decimal(14,2)"
RATE = "decimal(5,4)"
AMOUNT = "decimal(20,6)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast a money input to DECIMAL before any arithmetic."""
    return col(c).cast(MONEY)


def rate(c) -> Column:
    return col(c).cast(RATE)


def cents(c) -> Column:
    """Exact decimal rounded half-up to cents, reported as double."""
    return F.round(col(c), 2).cast("double")


def duration_minutes(start, end) -> Column:
    """Whole-second duration in minutes (unix seconds difference / 60)."""
    return (F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / F.lit(60.0)


def duration_minutes_exact(start, end) -> Column:
    """Duration in minutes keeping fractions of a second."""
    return F.expr(
        f"timestampdiff(MICROSECOND, {_sql(start)}, {_sql(end)})"
    ) / F.lit(60_000_000.0)


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass column names to SQL-form helpers")


def safe_ratio(num, den) -> Column:
    """num / den with a zero denominator giving NULL (never an ANSI error)."""
    return col(num) / F.nullif(col(den), F.lit(0))


def net_amount(amount, flag, factor: str = fixed.DISCOUNT_FACTOR) -> Column:
    """Discounted amount when the flag is 1, else the amount.

    The factor is a decimal literal, so a decimal amount stays exact."""
    return F.when(col(flag) == 1, col(amount) * F.lit(Decimal(factor))).otherwise(col(amount))


def present(c) -> Column:
    """A number as double, with NaN read as missing (NULL)."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)


def year_month(ts) -> Column:
    return F.date_format(col(ts), fixed.MONTH_FORMAT)


def date_key(d) -> Column:
    """Integer yyyymmdd key of a date or timestamp."""
    return F.date_format(col(d), fixed.DATE_KEY_FORMAT).cast("int")


def md5_bucket(c, n: int) -> Column:
    """Deterministic bucket from the first 32 bits of md5 of the text form.

    Same value in any engine that has md5, so bucket layouts and splits
    can be checked in SQL."""
    h = F.conv(F.substring(F.md5(col(c).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n))


def md5_unit(c) -> Column:
    """Deterministic number in [0, 1) from md5 of the text form."""
    h = F.conv(F.substring(F.md5(col(c).cast("string")), 1, 8), 16, 10).cast("double")
    return h / F.lit(4294967296.0)
