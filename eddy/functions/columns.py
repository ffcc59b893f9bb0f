"""Scalar column helpers (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["col_of", "to_event_time", "to_ntz", "flat_window", "ALERT"]


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_event_time(c: Column | str) -> Column:
    """A TIMESTAMP usable by watermarks (streaming refuses TIMESTAMP_NTZ).

    The session time zone is UTC, so the wall-clock value is unchanged."""
    return col_of(c).cast("timestamp")


def to_ntz(c: Column | str) -> Column:
    return col_of(c).cast("timestamp_ntz")


def flat_window(wcol: str = "window", prefix: str = "window") -> list[Column]:
    """Window struct -> ``<prefix>_start`` / ``<prefix>_end`` (TIMESTAMP_NTZ)."""
    return [to_ntz(F.col(f"{wcol}.start")).alias(f"{prefix}_start"),
            to_ntz(F.col(f"{wcol}.end")).alias(f"{prefix}_end")]


# Fixed value: alert prefix printed by the guarantee checks.
ALERT = "Alert: "
