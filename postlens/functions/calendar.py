"""Weekday and hour expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, first day Sunday, as the dashboard shows them.
DAY_NAMES = ("Dom", "Lun", "Mar", "Mer", "Gio", "Ven", "Sab")


def to_timestamp(text: Column) -> Column:
    """Timestamp in the session time zone; text that is no date gives NULL, also under ANSI."""
    return text.try_cast("timestamp")


def day(ts: Column) -> Column:
    """Weekday number, 1 = Sunday."""
    return F.dayofweek(ts)


def hour(ts: Column) -> Column:
    return F.hour(ts)


def day_name(day_number: Column, names: Sequence[str] = DAY_NAMES) -> Column:
    """Name of weekday 1..7; NULL for NULL or any other number."""
    return F.get(F.array(*[F.lit(n) for n in names]), day_number - 1)
