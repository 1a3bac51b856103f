"""Column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retentio.constants import TENURE_BANDS


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; null stays null (greatest/least would skip it)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), c)))


def round_even(c: Column | str, places: int) -> Column:
    """Round like NumPy/pandas: scale, round half to even, unscale.

    ``bround`` rounds the decimal text of the double, which differs from
    scaling in binary on values such as 1.015.
    """
    scale = float(10 ** places)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def percent(c: Column | str, places: int | None = None) -> Column:
    out = _c(c) * F.lit(100.0)
    return out if places is None else round_even(out, places)


def tenure_band(months: Column | str) -> Column:
    """Right-closed bins (lo, hi]; values outside every bin give null."""
    m = _c(months)
    out = None
    for lo, hi, label in TENURE_BANDS:
        cond = (m > F.lit(lo)) & (m <= F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def member_id(key: Column | str) -> Column:
    """'M' plus a zero-filled 5-digit number; longer numbers are kept whole."""
    return F.format_string("M%05d", _c(key))


def allocation_text(weight: Column | str) -> Column:
    w = _c(weight).cast("int")
    return F.format_string("%d%% Risk / %d%% Value", w, F.lit(100) - w)


def min_max_scale(c: Column | str, lo: Column, hi: Column) -> Column:
    """(c - lo) / (hi - lo); null when the range is empty."""
    c = _c(c)
    return F.try_divide(c - lo, hi - lo)


def money_text(c: Column | str, places: int = 2) -> Column:
    """'$1,234.56' (negative as '$-1,234.56', the format the reports print)."""
    return F.concat(F.lit("$"), F.format_number(_c(c), places))


def pct_text(c: Column | str, places: int = 0) -> Column:
    """A ratio as percent text, e.g. 0.8979 -> '90%'."""
    return F.concat(F.format_number(_c(c) * F.lit(100.0), places), F.lit("%"))


def months_text(c: Column | str) -> Column:
    """Whole months, e.g. 35.6 -> '36 mo'."""
    return F.concat(F.format_number(_c(c), 0), F.lit(" mo"))


def of_capacity_text(n: Column | str, capacity: int) -> Column:
    """'12 / 100'."""
    return F.concat(_c(n).cast("string"), F.lit(f" / {int(capacity)}"))


def spaced(c: Column | str) -> Column:
    """Underscores to spaces, e.g. feature names on a slide."""
    return F.translate(_c(c), "_", " ")


def today_text() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")
