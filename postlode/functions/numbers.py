"""Shares, durations and the activity window."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` in exact decimals, half up; NULL if the whole is 0."""
    share = F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0))
    return F.round(share, digits).cast(f"decimal(38,{digits})")


def duration_seconds(started: Column, finished: Column) -> Column:
    """Seconds between two timestamps, with fractions."""
    return (F.unix_micros(finished) - F.unix_micros(started)) / F.lit(1e6)


def active_since(last_seen: Column, as_of: datetime, window_days: int) -> Column:
    """Seen within the window, its first instant included."""
    return last_seen >= F.lit(as_of - timedelta(days=window_days))
