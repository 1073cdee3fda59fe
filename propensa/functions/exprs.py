"""Column expressions shared by the operators.

A value column with a declared ``scale`` (decimal places, 2 for money) is
aggregated in whole units of ``10 ** -scale``, so that sums, means and standard
deviations do not depend on partitioning or summation order.  Without a scale
values are aggregated as doubles, unrounded.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_US_PER_DAY = 86_400_000_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: str | _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal (folds to a constant, so it pushes down)."""
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            raise ValueError("give a wall-clock time without a time zone")
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def epoch_us(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz``, time-zone free."""
    t = _col(ts)
    return (
        F.unix_date(F.to_date(t)).cast("bigint") * F.lit(_US_PER_DAY)
        + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(t).cast("bigint") * F.lit(60_000_000)
        + (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint")
    )


def units(value: str | Column, scale: int | None) -> Column:
    """``value`` as whole units of ``10 ** -scale``: NaN, infinite and
    oversized values have none and count as null.  Without a scale, the
    value as a double."""
    if scale is None:
        return _col(value).cast("double")
    return F.round(_col(value) * F.lit(float(10 ** scale))).try_cast("bigint")


def unscaled(total: Column, scale: int | None) -> Column:
    """A total of ``units`` back in the column's own units (double)."""
    return total.cast("double") if scale is None else total.cast("double") / F.lit(float(10 ** scale))


def exact_sum(c: Column, scale: int | None) -> Column:
    """``sum`` of a ``units`` column; with a scale in decimal(30,0), which
    holds any 1e11 of them."""
    return unscaled(F.sum(c if scale is None else c.cast("decimal(20,0)")), scale)


def exact_mean(c: Column, scale: int | None) -> Column:
    """Mean of a ``units`` column; with a scale one division of two integers."""
    if scale is None:
        return F.avg(c)
    total = F.sum(c.cast("decimal(20,0)")).cast("double")
    return total / (F.count(c) * F.lit(10 ** scale)).cast("double")


def exact_std(c: Column, scale: int | None) -> Column:
    """Sample standard deviation of a ``units`` column; null below two rows.

    With a scale the squares are taken around ``q``, the mean to the nearest
    unit: ``sum(x^2) - 2 q sum(x) + n q^2`` is exact in decimal(38,0) and no
    larger than the sum of squares, so it does not overflow where that fits.
    """
    n = F.count(c)
    if scale is None:
        return F.when(n >= 2, F.stddev_samp(c))
    d = c.cast("decimal(20,0)")
    return std_of(n, F.sum(d), F.sum(d * d), scale)


def std_of(n: Column, wide: Column, squares: Column, scale: int) -> Column:
    """Sample standard deviation from the count, sum and sum of squares of
    whole units."""
    q = F.round(wide.cast("double") / F.nullif(n, F.lit(0)).cast("double")).cast("decimal(20,0)")
    around = squares - F.lit(2) * (q * wide) + n.cast("decimal(20,0)") * (q * q)
    rest = (wide - n.cast("decimal(20,0)") * q).cast("double")
    var = (around.cast("double") - rest * rest / n.cast("double")) / (n - F.lit(1)).cast("double")
    return F.when(n >= 2, unscaled(F.sqrt(F.greatest(var, F.lit(0.0))), scale))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields null on a zero denominator (ANSI mode safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def parse_prop(props: str | Column, key: str, dtype: str = "int") -> Column:
    """One property of a JSON string column, typed; null if it is missing,
    malformed or of another type, as with :func:`parse_props`."""
    return F.get_json_object(_col(props), f"$.{key}").try_cast(dtype)


def parse_props(props: str | Column, schema: str) -> Column:
    """Several properties at once as a struct (``schema`` in DDL, e.g.
    ``"k int, src string"``): each string is parsed once, however many keys
    are read.  Missing keys and malformed strings give nulls."""
    return F.from_json(_col(props), schema, {"mode": "PERMISSIVE"})


def fold_of(key: str | Column, k: int) -> Column:
    """Stable fold in [0, k) from the first 32 bits of md5(key); a null key
    has the fold of the empty string."""
    text = F.coalesce(_col(key).cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10)
    return F.pmod(h.cast("bigint"), F.lit(k)).cast("int")
