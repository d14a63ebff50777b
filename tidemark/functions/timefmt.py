"""ISO-8601 rendering of event times, as the change events carry them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: ISO-8601 layouts of the event ``timestamp`` field ---
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
UTC_SUFFIX = "+00:00"
# --- end of fixed values ---


def iso_utc(ts: Column | str, micros: bool = False) -> Column:
    """Wall-clock UTC time → ``2024-01-01T00:00:07[.179575]+00:00``.

    The ``+00:00`` suffix (not ``Z``) keeps lexicographic order equal to time order:
    ``+`` sorts before ``.``, so a whole-second value still sorts before its fractions.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.date_format(c, ISO_MICROS if micros else ISO_SECONDS), F.lit(UTC_SUFFIX))


def parse_event_time(s: Column | str) -> Column:
    """ISO string → timestamp; malformed values become null instead of failing (ANSI)."""
    c = F.col(s) if isinstance(s, str) else s
    return c.try_cast("timestamp")
