"""Epoch milliseconds to event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_ms_to_event_time(ms: Column) -> Column:
    """Whole-second event time from epoch milliseconds.

    Truncates toward zero like ``from_unixtime(ms / 1000)`` does, but without
    the detour through a time-zone dependent string, so a DST overlap in the
    session zone cannot move a row by an hour.  Null stays null.
    """
    # ``%`` keeps the dividend's sign, so ``ms - ms % 1000`` truncates toward
    # zero (-1500 ms -> -1 s) and stays an exact integer of milliseconds.
    return F.timestamp_millis(ms - ms % F.lit(1000))


def to_event_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Replace the epoch-ms ``column`` with a ``timestamp`` typed column."""
    return df.withColumn(column, epoch_ms_to_event_time(F.col(column)))
