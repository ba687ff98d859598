"""Column helpers shared by every layer. All are built-in Spark expressions (no UDFs)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

def hundred() -> Column:
    """SQL's `100.0` is DECIMAL(4,1); a Python float literal would silently turn the
    arithmetic into DOUBLE, so every percentage uses this decimal constant."""
    return F.lit(Decimal("100.0"))


def zero_qty() -> Column:
    return F.lit(0).cast("decimal(10,2)")

# Inputs to exact ratios carry at most this many decimals (money x quantity = 4).
_RATIO_INPUT_SCALE = 4


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: Column | str) -> Column:
    """Enum normalisation used by every staging model: lower(trim(x))."""
    return F.lower(F.trim(col(c)))


def week_start(d: Column | str) -> Column:
    """Monday of the week of a date (date_trunc('week') returns a timestamp)."""
    return F.date_trunc("week", col(d)).cast("date")


def zero_if_null(c: Column | str) -> Column:
    """NULL confirmed quantity counts as 0 in revenue, fill and shortage."""
    return F.coalesce(col(c), zero_qty())


def nullif_zero(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(0))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL (not an error under ANSI mode) when den is 0 or NULL."""
    return col(num) / nullif_zero(den)


def pct_unrounded(num: Column | str, den: Column | str) -> Column:
    """num * 100.0 / nullif(den, 0) in decimal arithmetic (Spark keeps 14 decimals)."""
    return col(num) * hundred() / nullif_zero(den)


def _unscaled(c: Column) -> Column:
    """The value as an integer in units of its last allowed decimal; a finer value is an error, not cut."""
    at_scale = c.cast("decimal(38,4)")
    finer = F.raise_error(F.lit("round_ratio: an input has more than 4 decimals")).cast("decimal(38,0)")
    return F.when(c.isNull() | (at_scale == c), (at_scale * F.lit(10**_RATIO_INPUT_SCALE)).cast("decimal(38,0)")).otherwise(finer)


def round_ratio(num: Column | str, den: Column | str, scale: int, multiplier: int = 1) -> Column:
    """Exact ROUND(num * multiplier / den, scale), half away from zero, NULL-guarded.

    Decimal division in Spark rounds the quotient to a fixed scale before ROUND is
    applied, which can move a value across a .5 boundary. Here the quotient is
    never materialised: both operands become integers and the rounded result is
    one integral division, so the answer equals exact (PostgreSQL numeric) rounding.
    """
    n = _unscaled(col(num))
    d = F.nullif(_unscaled(col(den)), F.lit(0))
    q = F.call_function("div", F.abs(n) * F.lit(2 * multiplier * 10**scale) + F.abs(d), F.abs(d) * F.lit(2))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return (signed.cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def safe_pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """round(num * 100.0 / nullif(den, 0), scale) with exact half-up rounding."""
    return round_ratio(num, den, scale, multiplier=100)


def on_time_flag(status: Column | str, delivered_at: Column | str, scheduled_at: Column | str) -> Column:
    """1 when delivered on the scheduled calendar date, else 0 (early is not on time)."""
    same_day = col(delivered_at).cast("date") == col(scheduled_at).cast("date")
    return F.when((col(status) == "delivered") & same_day, F.lit(1)).otherwise(F.lit(0))
