"""Helpers to register a query next to its oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwell.fixtures import RUN_DATE, oracle_views
from layerwell.functions.columns import day_shift

D = RUN_DATE
D7 = day_shift(D, -6)
D30 = day_shift(D, -29)
AS_OF_TIME = "2024-01-15 12:00:00"

# Views of cleaned tables for oracles, written as a plain SQL user would.
CTES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Values in types both engines print alike: decimals as doubles, dates and times as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def half_up(numerator: str, denominator: str, places: int = 2) -> str:
    """SQL of a quotient of integers rounded half away from zero, as a double; denominator > 0."""
    n = f"(CAST({numerator} AS HUGEINT) * {10 ** places})"
    d = f"CAST({denominator} AS HUGEINT)"
    return f"(CAST(SIGN({n}) * ((2 * ABS({n}) + {d}) // (2 * {d})) AS DOUBLE) / {10 ** places})"


def mean2(column: str) -> str:
    """SQL of the average of a two-place decimal, rounded to two places."""
    return f"CASE WHEN COUNT({column}) > 0 THEN {half_up(f'SUM(CAST({column} * 100 AS BIGINT))', f'100 * COUNT({column})')} END"


def oracle(body: str) -> str:
    """Prefix a query with every view it reads, inputs first."""
    fixtures = dict(oracle_views(*_all_fixtures()))
    known = {**fixtures, **CTES}
    order: list[str] = []

    def add(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b\w+\b", sql)):
            if word in known and word not in order and known[word] is not sql:
                add(known[word])
                if word not in order:
                    order.append(word)

    add(body)
    if not order:
        return body
    head = ",\n".join(f"{name} AS (\n{known[name].strip()}\n)" for name in order)
    joiner = ",\n" if body.lstrip().upper().startswith("WITH ") else "\n"
    rest = body.lstrip()[5:] if joiner.startswith(",") else body
    return f"WITH {head}{joiner}{rest}"


def _all_fixtures() -> list[str]:
    from layerwell.fixtures import VIEWS

    return list(VIEWS)
