"""Day-first timestamp parsing, rendering and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.functions.text import btrim_ws
from wattline.schema import DATE_FORMAT, DATE_PARSE_FORMAT


def parse_day_first(c, fmt: str = DATE_PARSE_FORMAT) -> Column:
    """Trim and parse ``dd/MM/yyyy HH:mm``; null stays null, a bad value fails."""
    c = F.col(c) if isinstance(c, str) else c
    t = btrim_ws(c)
    parsed = F.try_to_timestamp(t, F.lit(fmt)).cast("timestamp_ntz")
    # parsed once; only what can't be is looked at again
    return F.coalesce(parsed, F.when(t.isNotNull(), F.raise_error(F.concat(F.lit("unparseable date: "), t)).cast("timestamp_ntz")))


def format_day_first(c, fmt: str = DATE_FORMAT) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, fmt)


def calendar_parts(c) -> dict[str, Column]:
    c = F.col(c) if isinstance(c, str) else c
    return {
        "year": F.year(c).cast("bigint"),
        "month": F.month(c).cast("bigint"),
        "day": F.dayofmonth(c).cast("bigint"),
        "hour": F.hour(c).cast("bigint"),
        "minute": F.minute(c).cast("bigint"),
    }
