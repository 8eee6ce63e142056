"""Decimal arithmetic helpers: exact ratios rounded once, half away from zero.

Spark's `avg(decimal)` rounds to scale+4 and a later `round` rounds again;
the serving database keeps more digits.  These helpers turn the numerator
into an exact integer (a decimal sum scaled by 10^scale), divide with
integral `div` and round half up in integer arithmetic, so cents agree with
an exact computation on every row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _int(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def div_half_up(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero, for integer-valued num and den > 0."""
    a = F.abs(num)
    q = F.call_function("div", _int(a * 2 + den), _int(den * 2))
    return F.when(num < 0, -q).otherwise(q)


def exact_ratio(num: Column, den: Column, scale: int, num_scale: int,
                out_precision: int = 22) -> Column:
    """round(num / den, scale) exactly; `num` is a decimal of scale `num_scale`,
    `den` a positive integer; null when den is 0 or null."""
    n_int = _int(num * F.lit(10 ** num_scale))
    q = div_half_up(n_int * F.lit(10 ** scale), _int(den) * F.lit(10 ** num_scale))
    out = (_int(q) / F.lit(10 ** scale).cast("decimal(38,0)")).cast(f"decimal({out_precision},{scale})")
    return F.when(den > 0, out)


def exact_avg(col: Column | str, scale: int, col_scale: int = 2, count: Column | None = None,
              out_precision: int = 22) -> Column:
    """round(sum(col) / count(col), scale) as an aggregate, one rounding."""
    c = F.col(col) if isinstance(col, str) else col
    n = count if count is not None else F.count(c)
    return exact_ratio(F.sum(c), n, scale, col_scale, out_precision)


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """round(100 * part / whole, scale) for integer counts, as decimal(9+scale, scale)."""
    return exact_ratio(part * F.lit(100), whole, scale, 0, 9 + scale)


def not_nan(col: Column) -> Column:
    """The value, or null when it is NaN (pandas-style sums skip NaN, N6)."""
    return F.when(~F.isnan(col), col)


def exact_sum(col: Column | str) -> Column:
    """Sum of a floating-point amount that does not depend on the order of rows or tasks, as an aggregate.

    Amounts are added as decimals of six places and the total becomes the nearest double.  Null when every
    value is null.  With a value that is no such decimal (NaN, infinite, 1e22 or more) it is the plain sum.
    """
    c = F.col(col) if isinstance(col, str) else col
    d = c.try_cast("decimal(28,6)")
    return F.when(F.count_if(c.isNotNull() & d.isNull()) > 0, F.sum(c)).otherwise(F.sum(d).cast("double"))
