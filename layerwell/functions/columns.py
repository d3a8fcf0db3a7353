"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Validation patterns and the text form of timestamps.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
EMAIL_RULE_PATTERN = r"^[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
MOBILE_PATTERN = r"^1[3-9]\d{9}$"
E164_PATTERN = r"^\+?[1-9]\d{1,14}$"
EMAIL_DOMAIN_PATTERN = "@(.+)"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_MARKS = "%-%-% %:%:%"
TIMESTAMP_PATTERN = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"

ONE_DAY = timedelta(days=1)


def day_shift(day: str, days: int) -> str:
    """``yyyy-MM-dd`` moved by a number of days; used to build prunable string bounds."""
    return (date.fromisoformat(day) + days * ONE_DAY).isoformat()


def non_blank(c: Column, default: str) -> Column:
    """Trimmed text, or the default where it is null or blank."""
    text = F.trim(c)
    return F.when(F.length(text) > 0, text).otherwise(F.lit(default))


def matching(c: Column, pattern: str) -> Column:
    """The value if it matches the pattern, else null."""
    return F.when(c.rlike(pattern), c)


def parse_time(c: Column) -> Column:
    """Timestamp of a ``yyyy-MM-dd HH:mm:ss`` text; null if malformed.

    A text that looks right is cast, which is several times cheaper than the formatter and gives the same. Without the
    format's marks no formatter reads a text, and it would raise and catch an error to say so; it decides on all others.
    """
    formatted = F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT))
    return F.when(c.rlike(TIMESTAMP_PATTERN), c.try_cast("timestamp")).when(c.like(TIMESTAMP_MARKS), formatted)


def non_negative_money(c: Column, decimal: str = "decimal(10,2)") -> Column:
    """Amount as decimal; null and negative amounts become 0."""
    return F.when(c >= 0, c.try_cast(decimal)).otherwise(F.lit(0).cast(decimal))


def recode(c: Column, codes: Mapping[str, Iterable[str]], default: str) -> Column:
    """Replace each listed raw code by its label; everything else becomes the default."""
    result = F
    for label, raw in codes.items():
        result = result.when(c.isin(*raw), F.lit(label))
    return result.otherwise(F.lit(default))


def band(c: Column, steps: Iterable[tuple[float, object]], default: object) -> Column:
    """Label of the first lower bound that the value reaches, else the default (also for null)."""
    result = F
    for bound, label in steps:
        result = result.when(c >= bound, F.lit(label))
    return result.otherwise(F.lit(default))


def ratio(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """Quotient that is null for a zero denominator instead of an error."""
    return F.try_divide(numerator * factor, denominator)


def clean_phone(c: Column) -> Column:
    """Digits only; null stays null."""
    return F.regexp_replace(c, "[^0-9]", "")


def age_years(birth: Column, as_of: Column) -> Column:
    """Full years from a birth-date text to a day; malformed text gives null."""
    born = F.try_to_date(birth, "yyyy-MM-dd")
    birthday_ahead = F.date_format(as_of, "MMdd") < F.date_format(born, "MMdd")
    return F.year(as_of) - F.year(born) - F.when(birthday_ahead, 1).otherwise(0)


def register_functions(spark: SparkSession) -> None:
    """Make the column functions callable from SQL as inlined SQL functions."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION clean_phone(phone STRING) RETURNS STRING "
        "RETURN regexp_replace(phone, '[^0-9]', '')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION age_years(birth STRING, as_of DATE) RETURNS INT "
        "RETURN year(as_of) - year(try_to_date(birth, 'yyyy-MM-dd')) - "
        "CASE WHEN date_format(as_of, 'MMdd') < date_format(try_to_date(birth, 'yyyy-MM-dd'), 'MMdd') "
        "THEN 1 ELSE 0 END"
    )
