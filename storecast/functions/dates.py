"""Date parsing and calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted layouts, whole string, padding optional.
ISO_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
DAY_FIRST_TEXT = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"


def parse_iso(text: Column) -> Column:
    """`2025-01-05` or `2025-1-5`; anything else, or an impossible day, is NULL."""
    return F.when(text.rlike(ISO_TEXT), F.try_to_date(text, "y-M-d"))


def parse_day_first(text: Column) -> Column:
    """`05/01/2025` or `5/1/2025`, always day first; anything else is NULL."""
    return F.when(text.rlike(DAY_FIRST_TEXT), F.try_to_date(text, "d/M/y"))


def repair_date(text: Column) -> Column:
    return F.coalesce(parse_iso(text), parse_day_first(text))


def calendar_days(start: str | dt.date, end: str | dt.date) -> Column:
    """Array of all days from `start` to `end`, both included."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    return F.sequence(first, last, F.expr("interval 1 day"))
