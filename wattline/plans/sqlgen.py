"""DuckDB oracle SQL fragments mirroring the Spark sources and operators.

Each fragment is a named CTE; :func:`with_` joins the needed ones in order.
"""

from __future__ import annotations

import math

from wattline.schema import (CATEGORICAL_COLUMNS, DAY_OF_WEEK_MAP, LOAD_TYPE_MAP, NA_LITERALS,
                             NUMERIC_COLUMNS, NUMERIC_NULL_TOKENS, OUTLIER_STEPS, RAW_COLUMNS,
                             SNAKE_COLUMNS, WEEK_STATUS_MAP)
from wattline.sources.dirty_rules import dirty_select_list

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
NUMBER_RE = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def r(expr: str, digits: int = 6) -> str:
    """Round like Spark's ``round`` on a double: half-up on the shortest decimal
    text of the value (not on its binary expansion), -0.0 folded to 0.0."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"(CASE WHEN isnan({x}) OR isinf({x}) THEN {x} ELSE CAST(round(CAST(CAST({x} AS VARCHAR) "
            f"AS DECIMAL(38,18)), {digits}) AS DOUBLE) END + 0.0)")


READINGS = """readings AS (
  SELECT event_id AS reading_id,
         CAST(ts AS TIMESTAMP) AS date,
         CAST(value AS DOUBLE) AS usage_kwh,
         k AS lagging_current_reactive_power_kvarh,
         CAST(user_id % 40 AS DOUBLE) AS leading_current_reactive_power_kvarh,
         value / 1000.0 AS co2_tco2,
         50.0 + k / 2.0 AS lagging_current_power_factor,
         100.0 - CAST(user_id % 50 AS DOUBLE) AS leading_current_power_factor,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS nsm,
         CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS week_status,
         dayname(ts) AS day_of_week,
         CASE event_id % 3 WHEN 0 THEN 'Light_Load' WHEN 1 THEN 'Medium_Load' ELSE 'Maximum_Load' END AS load_type
  FROM (SELECT *, TRY_CAST(regexp_extract(props, '"k":\\s*(-?[0-9.]+)', 1) AS DOUBLE) AS k FROM events)
)"""

TAGGED = """readings_tagged AS (
  SELECT r.*, e.event_type AS dataset FROM readings r JOIN events e ON e.event_id = r.reading_id
)"""


def dirty() -> str:
    sel = ",\n         ".join(f"{e} AS {qi(n)}" for e, n in dirty_select_list("duckdb"))
    return f"readings_dirty AS (\n  SELECT {sel}\n  FROM readings\n)"


def na_null(expr: str) -> str:
    return f"CASE WHEN {expr} IN {in_list(NA_LITERALS)} THEN NULL ELSE {expr} END"


def dirty_na() -> str:
    cols = ["reading_id"] + RAW_COLUMNS + ["mixed_type_col"]
    sel = ", ".join("reading_id" if c == "reading_id" else f"{na_null(qi(c))} AS {qi(c)}"
                    for c in cols)
    return f"dirty_na AS (SELECT {sel} FROM readings_dirty)"


def snake() -> str:
    sel = ", ".join(f"{qi(raw)} AS {sn}" for raw, sn in zip(RAW_COLUMNS, SNAKE_COLUMNS))
    return f"dirty_snake AS (SELECT reading_id, {sel}, mixed_type_col FROM dirty_na)"


def trim_ws(expr: str) -> str:
    return f"trim({expr}, {WS})"


def parse_date(expr: str) -> str:
    return f"strptime({trim_ws(expr)}, '%d/%m/%Y %H:%M')"


def numeric_strict(expr: str) -> str:
    return (f"CASE WHEN {expr} IS NULL OR {expr} IN {in_list(NUMERIC_NULL_TOKENS)} THEN NULL "
            f"WHEN regexp_matches({expr}, {lit(NUMBER_RE)}) THEN CAST(trim({expr}) AS DOUBLE) "
            f"ELSE error('unparseable number') END")


def numeric_lenient(expr: str) -> str:
    return (f"CASE WHEN {expr} IN {in_list(NUMERIC_NULL_TOKENS)} THEN NULL "
            f"WHEN regexp_matches({expr}, {lit(NUMBER_RE)}) THEN TRY_CAST(trim({expr}) AS DOUBLE) END")


def canon(expr: str, mapping: dict) -> str:
    t = trim_ws(expr)
    whens = " ".join(f"WHEN {t} = {lit(s)} THEN {('NULL' if d is None else lit(d))}"
                     for s, d in mapping.items())
    return f"CASE {whens} ELSE {t} END"


CATEGORY_MAPS = {"week_status": WEEK_STATUS_MAP, "day_of_week": DAY_OF_WEEK_MAP,
                 "load_type": LOAD_TYPE_MAP}


def typed() -> str:
    """Dates parsed, junk dropped, numbers strict (NSM as BIGINT)."""
    parts = ["reading_id", f"{parse_date('date')} AS date"]
    for c in NUMERIC_COLUMNS:
        e = numeric_strict(c)
        if c == "nsm":
            e = f"CAST({e} AS BIGINT)"
        parts.append(f"{e} AS {c}")
    parts += CATEGORICAL_COLUMNS
    return f"typed AS (SELECT {', '.join(parts)} FROM dirty_snake)"


def iqr_chain(src: str, steps, prefix: str = "o") -> tuple[list[str], str]:
    """CTEs for the chained IQR filter; returns (ctes, final name)."""
    ctes = [f"{prefix}0 AS (SELECT * FROM {src})"]
    for i, (col, k) in enumerate(steps, start=1):
        kk = f"CAST({float(k)!r} AS DOUBLE)"
        ctes.append(f"{prefix}b{i} AS (SELECT quantile_cont({col}, 0.25) AS q1, "
                    f"quantile_cont({col}, 0.75) AS q3 FROM {prefix}{i - 1})")
        ctes.append(f"{prefix}{i} AS (SELECT t.* FROM {prefix}{i - 1} t, {prefix}b{i} b WHERE "
                    f"b.q1 IS NULL OR t.{col} IS NULL OR t.{col} BETWEEN b.q1 - {kk} * (b.q3 - b.q1) "
                    f"AND b.q3 + {kk} * (b.q3 - b.q1))")
    return ctes, f"{prefix}{len(steps)}"


def clean_ctes(steps=OUTLIER_STEPS) -> list[str]:
    """readings -> readings_dirty -> ... -> readings_clean."""
    chain, last = iqr_chain("typed", steps)
    cats = ", ".join(f"{canon(c, CATEGORY_MAPS[c])} AS {c}" for c in CATEGORICAL_COLUMNS)
    cols = ["reading_id"] + SNAKE_COLUMNS
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return [READINGS, dirty(), dirty_na(), snake(), typed(), *chain,
            f"nsm_ok AS (SELECT * FROM {last} WHERE nsm <= 86399)",
            f"cats AS (SELECT reading_id, date, {', '.join(NUMERIC_COLUMNS)}, {cats} FROM nsm_ok)",
            f"readings_clean AS (SELECT {', '.join(cols)} FROM cats WHERE {notnull})"]


# -- reproducible draws (same formulas as wattline.functions.draws) -----------------

def _digits(seed: int, stream: str, i_expr: str, n: int) -> str:
    return (f"CAST(('0x' || substr(md5(concat({lit(str(seed))}, ':', {lit(stream)}, ':', "
            f"CAST({i_expr} AS VARCHAR))), 1, {n})) AS BIGINT)")


def hash60(seed: int, stream: str, i_expr: str) -> str:
    return _digits(seed, stream, i_expr, 15)


def uniform(seed: int, stream: str, i_expr: str) -> str:
    return f"((CAST({_digits(seed, stream, i_expr, 13)} AS DOUBLE) + 0.5) / {float(2 ** 52)!r}::DOUBLE)"


def normal(seed: int, stream: str, i_expr: str) -> str:
    u1 = uniform(seed, stream + ".a", i_expr)
    u2 = uniform(seed, stream + ".b", i_expr)
    return f"(sqrt(-2.0 * ln({u1})) * cos({2 * math.pi!r} * {u2}))"


def beta_sym(seed: int, stream: str, i_expr: str, alpha: float) -> str:
    c = f"cos({2 * math.pi!r} * {uniform(seed, stream + '.b', i_expr)})"
    square = f"((pow({uniform(seed, stream + '.a', i_expr)}, {-1.0 / alpha!r}) - 1.0) * {c} * {c})"
    return f"(CASE WHEN {square} > 0 THEN 0.5 + 0.5 * sign({c}) / sqrt(1.0 + 1.0 / {square}) ELSE 0.5 END)"
