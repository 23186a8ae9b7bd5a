"""Time as epoch milliseconds.

Event time stays a bigint from the wire to the last comparison, so a window test is a
plain ``column >= literal`` that Parquet can prune on and no session time zone is ever
consulted. Results show time as ``timestamp_ntz`` in UTC.
"""

from __future__ import annotations

import time

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_MS = 1_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# 0001-01-01 and 9999-12-31 23:59:59.999 in UTC.
FIRST_MS = -62_135_596_800_000
LAST_MS = 253_402_300_799_999


def now_ms() -> int:
    """The driver's clock in whole seconds, expressed in ms."""
    return int(time.time()) * SECOND_MS


def resolve(as_of_ms: int | None) -> int:
    """The instant a query is run for: the given one, else now, read once."""
    return now_ms() if as_of_ms is None else int(as_of_ms)


def midnight(as_of_ms: int) -> int:
    """Start of the UTC day that holds ``as_of_ms``."""
    return as_of_ms - as_of_ms % DAY_MS


def utc_seconds(ms: Column | str) -> Column:
    """Epoch ms to a UTC wall-clock time, dropping the part below a second.

    A broken device clock can send any bigint. Outside the years 1 to 9999 the answer is
    NULL, so one such row cannot fail a whole job.
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    # Integer division truncates, where "/" would give a double.
    whole = F.call_function("div", ms, F.lit(SECOND_MS).cast("bigint"))
    return F.when(
        ms.between(FIRST_MS, LAST_MS),
        epoch + F.make_dt_interval(secs=whole.cast("decimal(18,6)")),
    )


def _bucket(ms: Column | str, size: int) -> Column:
    ms = F.col(ms) if isinstance(ms, str) else ms
    return ms - F.pmod(ms, F.lit(size).cast("bigint"))


def hour_start_ms(ms: Column | str) -> Column:
    """Start of the hour as ms; a cheaper grouping key than a timestamp."""
    return _bucket(ms, HOUR_MS)


def day_start_ms(ms: Column | str) -> Column:
    """Start of the UTC day as ms."""
    return _bucket(ms, DAY_MS)


def utc_day(ms: Column | str) -> Column:
    """UTC date, by whole-number arithmetic; NULL outside the years 1 to 9999."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    days = F.call_function("div", day_start_ms(ms), F.lit(DAY_MS).cast("bigint"))
    epoch = F.lit("1970-01-01").cast("date")
    return F.when(ms.between(FIRST_MS, LAST_MS), F.date_add(epoch, days.cast("int")))
