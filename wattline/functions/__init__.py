"""Column-expression helpers (all JVM-side built-ins)."""

from wattline.functions.text import (btrim_ws, swapcase, na_literals_to_null,
                                     canonicalize, numeric_strict, numeric_lenient)
from wattline.functions.dates import parse_day_first, calendar_parts, format_day_first
from wattline.functions.numeric import (nan_to_null, strict_integer, clip, r, safe_pct_error)
from wattline.functions.params import params_to_string
from wattline.functions.draws import uniform, normal, beta_sym

__all__ = [
    "btrim_ws", "swapcase", "na_literals_to_null", "canonicalize", "numeric_strict",
    "numeric_lenient", "parse_day_first", "calendar_parts", "format_day_first",
    "nan_to_null", "strict_integer", "clip", "r", "safe_pct_error", "params_to_string",
    "uniform", "normal", "beta_sym",
]
