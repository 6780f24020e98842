"""Time helpers: the logical run date, the open-interval sentinel and timestamp conversions.

Fixed value: an open SCD interval ends at 9999-12-31 00:00:00 (the source tables used the string
'9999-12-31'; here it is a real timestamp so that ``valid_to`` compares as a timestamp).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

OPEN_END_TEXT = "9999-12-31 00:00:00"
_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def resolve_as_of(as_of: dt.date | str | None = None, latency: int | None = None) -> dt.date:
    """The logical run date.

    ``as_of`` (string ``YYYY-MM-DD`` or date; default: today) shifted by the signed day offset ``latency``
    (-4 = four days before), which is how the specs express "the day to load".
    """
    if as_of is None:
        day = dt.date.today()
    elif isinstance(as_of, dt.datetime):
        day = as_of.date()
    elif isinstance(as_of, dt.date):
        day = as_of
    else:
        day = dt.date.fromisoformat(str(as_of))
    return day + dt.timedelta(days=int(latency or 0))


def open_end(like: DataType | None = None) -> Column:
    """The open-interval sentinel as a timestamp literal of the same flavour as ``like``."""
    if like is None or isinstance(like, TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{OPEN_END_TEXT}'")
    return F.expr(f"TIMESTAMP '{OPEN_END_TEXT}'")


def millis_to_ntz(ms: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ in UTC wall-clock time (exact, no double arithmetic)."""
    return F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH_NTZ))


def day_window_filter(col: Column, as_of: dt.date, how: str = "eq") -> Column:
    """``to_date(col) = as_of`` (``how='eq'``), ``<= as_of`` (``how='le'``) or ``> as_of`` (``how='gt'``).

    Catalyst turns both into range predicates on ``col`` that reach Parquet/JDBC scans and prune
    partitions when ``col`` is a partition column.
    """
    day = F.lit(as_of)
    if how == "eq":
        return F.to_date(col) == day
    if how == "le":
        return F.to_date(col) <= day
    if how == "gt":
        return F.to_date(col) > day
    raise ValueError(f"unknown day filter {how!r}")
