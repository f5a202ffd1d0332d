"""Field extraction from nested raw records."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = r"^-?[0-9]+$"
_FIRST_SECOND, _LAST_SECOND = -62_135_596_800, 253_402_300_799  # years 1 to 9999


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_get(col, default=None) -> Column:
    """A (possibly nested) field, with ``default`` when it is NULL or missing.

    A struct path to an absent key is NULL under the declared raw schema, so
    "missing" and "null" collapse into one ``coalesce``.
    """
    c = _c(col)
    return c if default is None else F.coalesce(c, F.lit(default))


def ts_utc(col) -> Column:
    """Epoch seconds or ISO-8601 text -> UTC timestamp; NULL passes through,
    and a text that is neither is NULL."""
    c = _c(col)
    seconds = c.try_cast("bigint")
    return (F.when(c.rlike(_EPOCH), F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds)))
             .otherwise(c.try_cast("timestamp")))


def first_item(arr) -> Column:
    """The first element of an array, NULL for an empty or NULL array.

    ``get`` rather than ``[0]``: under ANSI mode ``[0]`` raises on an empty array.
    """
    return F.get(_c(arr), 0)


def interval_count(recurring) -> Column:
    """``recurring.interval_count`` defaulting to 1, but only when
    ``recurring`` holds something: an empty object counts as absent (NULL)."""
    r = _c(recurring)
    count, interval = r.getField("interval_count"), r.getField("interval")
    return F.when(count.isNotNull() | interval.isNotNull(), F.coalesce(count, F.lit(1).cast("bigint")))


def stamp(now) -> Column:
    """One run-constant ``extracted_at`` value (never a per-stage clock)."""
    if isinstance(now, Column):
        return now
    if isinstance(now, str):
        return F.to_timestamp(F.lit(now))
    if isinstance(now, _dt.datetime) and now.tzinfo is not None:
        now = now.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.to_timestamp(F.lit(now.isoformat(sep=" ")))
    return F.lit(now).cast("timestamp")
