"""Deterministic rules that render clean readings as a dirty text file.

Written once as SQL expression text over the columns of the clean readings,
so the Spark table (``F.expr``) and the DuckDB oracle use the very same rule.
Only the date rendering differs by dialect.
"""

from __future__ import annotations

import string

from wattline.schema import (CATEGORICAL_COLUMNS, NUMERIC_COLUMNS, NUMERIC_NULL_TOKENS,
                             RAW_COLUMNS)

_UP, _LOW = string.ascii_uppercase, string.ascii_lowercase


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _token(idx_expr: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {_lit(t)}" for i, t in enumerate(NUMERIC_NULL_TOKENS))
    return f"(CASE {idx_expr} {whens} END)"


def numeric_kind(j: int) -> str:
    """How numeric column j of a row is rendered in Spark: 0 to 8 a junk token, 9 a blank,
    10 an NA literal, 11 padded, 12 plain."""
    m = f"(reading_id + {3 * j})"
    return (f"CASE WHEN {m} % 97 = 0 OR {m} % 89 = 0 OR {m} % 83 = 0 THEN (reading_id + {j}) % 9 "
            f"WHEN {m} % 101 = 0 THEN 9L WHEN {m} % 103 = 0 THEN 10L WHEN (reading_id + {j}) % 29 = 0 THEN 11L ELSE 12L END")


def numeric_text(j: int, col: str, dialect: str = "spark") -> str:
    """Text of numeric column j: junk token, blank, NA literal, padded or plain.
    Doubles are written with six decimals (the source values have at most five). In
    Spark `col` is that text already (`six_decimals`), and the row's kind is in `col`_kind."""
    if dialect == "spark":
        texts = ", ".join(map(_lit, [*NUMERIC_NULL_TOKENS, "", "n/a"]))
        return f"CASE WHEN {col}_kind <= 10 THEN get(array({texts}), CAST({col}_kind AS INT)) WHEN {col}_kind = 11 THEN concat(' ', {col}, ' ') ELSE {col} END"
    m = f"(reading_id + {3 * j})"
    text = f"printf('%.6f', {col})"
    if col == "nsm":  # some corrupt seconds-from-midnight values
        text = f"CAST({corrupt_nsm()} AS STRING)"
    return (f"CASE WHEN {m} % 97 = 0 OR {m} % 89 = 0 OR {m} % 83 = 0 "
            f"THEN {_token(f'(reading_id + {j}) % 9')} "
            f"WHEN {m} % 101 = 0 THEN '' "
            f"WHEN {m} % 103 = 0 THEN 'n/a' "
            f"WHEN (reading_id + {j}) % 29 = 0 THEN concat(' ', {text}, ' ') "
            f"ELSE {text} END")


def corrupt_nsm() -> str:
    return "CASE WHEN reading_id % 53 = 0 THEN nsm + 86400 ELSE nsm END"


def six_decimals(col: str, plain: str) -> str:
    """Spark's format_string('%.6f', col), `plain` being the column as plain text. A number
    that this text gives in full, with six decimals or fewer, is only filled up with zeros:
    the formatter takes the same digits, but many times as long."""
    return (f"CASE WHEN (abs({col}) >= 0.001D AND abs({col}) < 10000000D OR {col} = 0D) AND length({plain}) - instr({plain}, '.') <= 6 "
            f"THEN rpad({plain}, instr({plain}, '.') + 6, '0') ELSE format_string('%.6f', {col}) END")


def category_text(k: int, col: str) -> str:
    m = f"(reading_id + {7 * k})"
    inner = (f"CASE WHEN {m} % 107 = 0 THEN 'NAN' "
             f"WHEN {m} % 31 = 0 THEN translate({col}, '{_UP}{_LOW}', '{_LOW}{_UP}') "
             f"ELSE {col} END")
    return (f"CASE WHEN (reading_id + {k}) % 13 = 0 THEN concat('  ', {inner}, ' ') "
            f"ELSE {inner} END")


def date_text(rendered: str) -> str:
    return f"CASE WHEN reading_id % 41 = 0 THEN concat(' ', {rendered}, '  ') ELSE {rendered} END"


def junk_text() -> str:
    return "concat('m', CAST(reading_id % 7 AS STRING))"


def dirty_select_list(dialect: str) -> list[tuple[str, str]]:
    """(expression, raw column name) pairs, in file order, plus the key and junk."""
    if dialect == "spark":
        rendered = "date_format(date, 'dd/MM/yyyy HH:mm')"
    else:
        rendered = "strftime(date, '%d/%m/%Y %H:%M')"
    out = [("reading_id", "reading_id"), (date_text(rendered), RAW_COLUMNS[0])]
    for j, col in enumerate(NUMERIC_COLUMNS):
        out.append((numeric_text(j, col, dialect), RAW_COLUMNS[1 + j]))
    # raw file order of the categoricals: WeekStatus, Day_of_week, Load_Type
    for k, col in enumerate(CATEGORICAL_COLUMNS):
        out.append((category_text(k, col), RAW_COLUMNS[8 + k]))
    out.append((junk_text(), "mixed_type_col"))
    return out
