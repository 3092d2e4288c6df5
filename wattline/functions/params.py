"""Rendering of hyper-parameter maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def params_to_string(m) -> Column:
    """MAP<STRING,STRING> -> ``"k=v, k=v"`` in map order; empty or null -> ``default``."""
    m = F.col(m) if isinstance(m, str) else m
    joined = F.array_join(
        F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])),
        ", ",
    )
    return F.when(m.isNull() | (F.size(m) == 0), F.lit("default")).otherwise(joined)
