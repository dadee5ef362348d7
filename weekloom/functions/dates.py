"""Calendar expressions: week and month keys, calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weekloom.functions.scalars import map_values

# Month names of the calendar dimension.
MONTH_NAMES_PT = {
    1: "Janeiro", 2: "Fevereiro", 3: "Março", 4: "Abril", 5: "Maio", 6: "Junho",
    7: "Julho", 8: "Agosto", 9: "Setembro", 10: "Outubro", 11: "Novembro", 12: "Dezembro",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def week_end(day) -> Column:
    """The Sunday that closes the Monday-to-Sunday week of ``day``."""
    return F.next_day(F.date_sub(_c(day), 1), "Sunday")


def month_start(day) -> Column:
    return F.trunc(_c(day), "month")


def days_in_month(day) -> Column:
    return F.dayofmonth(F.last_day(_c(day)))


def month_days(day) -> Column:
    """Array of every date in the month of ``day``."""
    return F.sequence(month_start(day), F.last_day(_c(day)))


def month_from_parts(year, month) -> Column:
    """First of the month from a year and a month column; null if either is unusable."""
    return F.try_make_timestamp(
        _c(year).try_cast("int"), _c(month).try_cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")


def month_name_pt(day) -> Column:
    return map_values(F.month(_c(day)), MONTH_NAMES_PT)


def year_part(day, months: int) -> Column:
    """1-based part of the year with ``months`` months each: 6 = semester, 4 = four-month term."""
    return (F.floor((F.month(_c(day)) - 1) / months) + 1).cast("int")
