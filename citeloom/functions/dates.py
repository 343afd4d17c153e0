"""Dates: strict ISO parsing for options and columns, and the run-start stamp."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = "[0-9]{4}-[0-9]{2}-[0-9]{2}"


def iso_date(text: Column) -> Column:
    """DATE for ``YYYY-MM-DD`` text, null for anything else (casts accept ``2024-1-5``)."""
    return F.when(text.rlike(f"^{_ISO}\\z"), F.try_to_date(text, "yyyy-MM-dd"))


def date_error(option: str, text: Column) -> Column:
    """Error text for a given but unparsable date, null for good or absent ones."""
    return F.when(
        text.isNotNull() & iso_date(text).isNull(),
        F.concat(F.lit(f"Invalid date for {option}: "), text),
    )


def parse_date_option(option: str, value: str | dt.date | None) -> dt.date | None:
    """Driver-side twin of :func:`iso_date` for arguments of the entry points."""
    if value is None or isinstance(value, dt.date):
        return value
    try:
        if re.fullmatch(_ISO, value):
            return dt.date.fromisoformat(value)
    except ValueError:
        pass
    raise ValueError(f"Invalid date for {option}: {value}")


def utc_stamp(moment: dt.datetime) -> str:
    """UTC, second precision, ``Z`` suffix."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc)
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")
