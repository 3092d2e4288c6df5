"""String cleaning: whitespace, case, missing-value literals, token parsing."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.schema import NA_LITERALS, NUMERIC_NULL_TOKENS

WHITESPACE = " \t\n\r\f\v"
# A plain decimal number, optionally padded (what a strict CSV number parser takes).
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def btrim_ws(c) -> Column:
    """Strip all ASCII whitespace from both ends (``trim`` only strips spaces)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def swapcase(c) -> Column:
    up, low = string.ascii_uppercase, string.ascii_lowercase
    return F.translate(_c(c), up + low, low + up)


def na_literals_to_null(c) -> Column:
    """Exact-match missing-value literals of a CSV reader become null."""
    c = _c(c)
    return F.when(c.isin(NA_LITERALS), F.lit(None).cast("string")).otherwise(c)


def canonicalize(c, mapping: dict) -> Column:
    """Trim, then map exact values (a None target means null); others pass."""
    t = btrim_ws(c)
    nothing = [src for src, dst in mapping.items() if dst is None]
    spelled = [F.lit(x) for src, dst in mapping.items() if dst is not None for x in (src, dst)]
    out = F.coalesce(F.create_map(*spelled)[t], t) if spelled else t
    return F.when(t.isin(nothing), F.lit(None).cast("string")).otherwise(out) if nothing else out


def _is_number(c: Column) -> Column:
    return c.rlike(NUMBER_PATTERN)


def numeric_strict(c, name: str = "value") -> Column:
    """Known junk tokens -> null; everything else must be a number or the job fails."""
    c = _c(c)
    # no token is a number, so numbers are tried first, and once
    other = F.when(c.isNull() | c.isin(NUMERIC_NULL_TOKENS), F.lit(None).cast("double")).otherwise(
        F.raise_error(F.concat(F.lit(f"unparseable number in {name}: "), c)).cast("double"))
    return F.coalesce(F.when(_is_number(c), c.try_cast("double")), other)


def numeric_lenient(c) -> Column:
    """Known junk tokens and anything unparseable -> null."""
    c = _c(c)
    return (F.when(c.isin(NUMERIC_NULL_TOKENS), F.lit(None).cast("double"))
             .when(_is_number(c), c.try_cast("double")))
