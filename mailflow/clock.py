"""Reference time: every time-relative operator takes ``as_of``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F


def moment(value) -> Column:
    """A time given as text, datetime or column, as zone-less UTC.

    A datetime goes in as text: as a literal it would be read in the zone of
    the machine.  One with a zone is converted, one without is UTC already.
    """
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def as_of_column(df: DataFrame, time_col: str, as_of=None) -> Column:
    """The reference time: given, or the latest time in the table (a scalar
    subquery, so it is one value wherever it is used)."""
    return df.select(F.max(time_col)).scalar() if as_of is None else moment(as_of)


def ago(time: Column, **parts: int) -> Column:
    return time - F.make_dt_interval(
        F.lit(parts.get("days", 0)), F.lit(parts.get("hours", 0)), F.lit(parts.get("minutes", 0))
    )
