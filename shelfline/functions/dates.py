"""Date rules: one accepted text format and the calendar attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(col: Column) -> Column:
    """Text in exactly yyyy-MM-dd form to date; anything else becomes null.

    The cast alone would also take "2025" or a date with a time; checking the
    form first is several times faster than parsing with a format string.
    """
    return F.when(col.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), col.try_cast("date"))


def calendar_columns(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date, with full English names."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_of_week": F.date_format(day, "EEEE"),
    }
