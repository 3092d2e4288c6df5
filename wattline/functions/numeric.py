"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """Floating NaN becomes SQL null (aggregates would otherwise count it)."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def strict_integer(c, name: str = "value") -> Column:
    """Whole double -> BIGINT; a fractional value fails the job (no truncation)."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None).cast("bigint")).when(
        c != F.floor(c),
        F.raise_error(F.concat(F.lit(f"fractional value in {name}: "), c.cast("string")))
         .cast("bigint"),
    ).otherwise(c.cast("bigint"))


def clip(c, lo: float | None, hi: float | None) -> Column:
    """Clip into [lo, hi]; nulls stay null."""
    c = _c(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def r(c, digits: int = 6) -> Column:
    """Round for comparison with an oracle (half away from zero); -0.0 -> 0.0."""
    return F.round(_c(c).cast("double"), digits) + F.lit(0.0)


def safe_pct_error(residual, actual) -> Column:
    """100 * residual / actual; null where actual is 0."""
    return F.lit(100.0) * F.try_divide(_c(residual), _c(actual))
