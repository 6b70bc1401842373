"""Date expressions and the fiscal calendar."""

import datetime as dt

from pyspark.sql import Column, functions as F

from obligato.fixed_values import LOOKBACK_FISCAL_YEARS


def fiscal_year(day: Column) -> Column:
    """Federal fiscal year, which starts on 1 October."""
    return F.year(F.add_months(day, 3)).cast("bigint")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def month_of(day: Column) -> Column:
    return F.trunc(day, "MONTH")


def in_last_months(day: Column, as_of: Column, months: int) -> Column:
    """Strictly later than the same day ``months`` months before ``as_of``."""
    return day > F.add_months(as_of, -months)


def fiscal_year_of(day: dt.date) -> int:
    return day.year + (day.month >= 10)


def lookback_window(today: dt.date, years: int = LOOKBACK_FISCAL_YEARS) -> tuple[dt.date, dt.date]:
    """From 1 October of the oldest of ``years`` fiscal years (the current one included) to today."""
    return dt.date(fiscal_year_of(today) - years, 10, 1), today


def fiscal_years(today: dt.date, years: int = LOOKBACK_FISCAL_YEARS) -> list[int]:
    newest = fiscal_year_of(today)
    return list(range(newest - years + 1, newest + 1))
