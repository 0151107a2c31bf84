"""Report dates from file names, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricegrid.functions.text import strip
from pricegrid.functions.urls import report_name

# The month names looked for, in calendar order.
MONTHS = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
    "septiembre", "octubre", "noviembre", "diciembre",
)
DEFAULT_YEAR = 2017


def month_names(text: Column) -> Column:
    """All month names in order, in the case they were written."""
    return F.regexp_extract_all(text, F.lit(f"(?i)({'|'.join(MONTHS)})"), F.lit(1))


def two_digit_days(text: Column) -> Column:
    """Two digits between non-digits, dashes dropped.

    A match uses up the characters on both sides, so of two days that share
    one dash only the first is found.
    """
    found = F.regexp_extract_all(text, F.lit("[^0-9][0-9]{2}[^0-9]"), F.lit(0))
    return F.transform(found, lambda day: F.replace(day, F.lit("-"), F.lit("")))


def four_digit_years(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[0-9]{4}"), F.lit(0))


def month_number(name: Column) -> Column:
    """1 to 12, NULL for anything else."""
    position = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(name))
    return F.nullif(position.cast("int"), F.lit(0))


def make_date(year: Column, month: Column, day: Column) -> Column:
    """Date from a year text, a month number and a day text, NULL if it is none.

    What was found around the two digits of a day may make it no number.
    """
    day = F.ltrim(strip(day), F.lit("+"))
    valid = (F.length(day) == 2) & (year != "0000")
    return F.when(valid, F.concat_ws("-", year, month.cast("string"), day)).try_cast("date")


def add_report_dates(df: DataFrame, url: str) -> DataFrame:
    """Add ``start_date, end_date, date_error, range_inverted`` read from a URL.

    The start is the first year, month and day found, by default 2017, January
    and 1. The end is the second of each, by default the start's. If either
    date cannot be made both are NULL and ``date_error`` is set. A range that
    ends before it starts is kept and flagged.
    """
    year, month, day = F.col("_year"), F.col("_month"), F.col("_day")
    start, end = F.col("_start"), F.col("_end")
    broken = start.isNull() | end.isNull()

    def nth(values: Column, i: int) -> Column:
        return F.get(values, F.lit(i))

    return (
        df.withColumn("_name", report_name(F.col(url)))
        .withColumns(
            {
                "_years": four_digit_years(F.col("_name")),
                "_months": month_names(F.col("_name")),
                "_days": two_digit_days(F.col("_name")),
            }
        )
        .withColumns(
            {
                "_year": F.coalesce(nth(F.col("_years"), 0), F.lit(str(DEFAULT_YEAR))),
                "_month": F.coalesce(month_number(nth(F.col("_months"), 0)), F.lit(1)),
                "_day": F.coalesce(nth(F.col("_days"), 0), F.lit("01")),
            }
        )
        .withColumns(
            {
                "_start": make_date(year, month, day),
                "_end": make_date(
                    F.coalesce(nth(F.col("_years"), 1), year),
                    F.coalesce(month_number(nth(F.col("_months"), 1)), month),
                    F.coalesce(nth(F.col("_days"), 1), day),
                ),
            }
        )
        .withColumns(
            {
                "start_date": F.when(~broken, start),
                "end_date": F.when(~broken, end),
                "date_error": broken,
                "range_inverted": F.coalesce(end < start, F.lit(False)),
            }
        )
        .drop("_name", "_years", "_months", "_days", "_year", "_month", "_day", "_start", "_end")
    )
