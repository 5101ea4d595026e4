"""Periods (``yyyymm`` texts), fiscal years and weekdays."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from netaudit.constants import MONTH_ABBREVIATIONS, WEEKDAYS


def previous_period(today: date) -> str:
    """The month before the run date, which a run covers unless told otherwise."""
    return shift_period(f"{today:%Y%m}", -1)


def shift_period(yyyymm: str, months: int) -> str:
    count = int(yyyymm[:4]) * 12 + int(yyyymm[4:]) - 1 + months
    return f"{count // 12}{count % 12 + 1:02d}"


def trend_periods(yyyymm: str) -> list[str]:
    """The thirteen months from the same month of last year up to ``yyyymm``."""
    return [shift_period(yyyymm, -back) for back in range(12, -1, -1)]


def shift_period_column(yyyymm: Column, months: int) -> Column:
    first = F.to_date(F.concat(yyyymm, F.lit("01")), "yyyyMMdd")
    return F.date_format(F.add_months(first, months), "yyyyMM")


def month_number(abbreviation: Column) -> Column:
    """1 to 12 for an English month abbreviation, else null."""
    position = F.array_position(F.array(*map(F.lit, MONTH_ABBREVIATIONS)), abbreviation)
    return F.when(position > 0, position.cast("int"))


def calendar_year(period: Column) -> Column:
    """Year text of ``Y年M月``."""
    return F.regexp_replace(period, "年.*", "")


def calendar_month(period: Column) -> Column:
    """Month number of ``Y年M月``."""
    return F.regexp_extract(period, r"(\d+)月", 1).try_cast("int")


def fiscal_year(period: Column) -> Column:
    """Fiscal year, starting in April, of ``Y年M月``."""
    year = calendar_year(period).try_cast("int")
    return F.when(calendar_month(period) >= 4, year).otherwise(year - 1)


def fiscal_year_of(day: date) -> int:
    return day.year if day.month >= 4 else day.year - 1


def calendar_yyyymm(period: Column) -> Column:
    return F.concat(calendar_year(period), F.lpad(calendar_month(period).cast("string"), 2, "0"))


def japanese_weekday(year: Column, month: Column, day: Column) -> Column:
    """One-character weekday; blank when month or day is missing, null for no such date."""
    when = F.try_to_date(F.concat_ws("-", year, month, day), "y-M-d")
    names = F.array(*map(F.lit, WEEKDAYS))
    return F.when(month.isNull() | day.isNull(), "").otherwise(F.get(names, F.weekday(when)))
