"""Time arithmetic on the regular grid. Every stamp is UTC."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NOTE_TIME_FORMATS

_UNIT_SECONDS = {"sec": 1, "min": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(period: int | str) -> int:
    """``900``, ``"15 minutes"``, ``"1 hour"``, ``"7 days"`` -> seconds."""
    if isinstance(period, int):
        return period
    m = re.fullmatch(r"\s*(\d*)\s*([a-zA-Z]+?)s?\s*", period)
    unit = m and next((v for k, v in _UNIT_SECONDS.items() if m[2].lower().startswith(k)), None)
    if not unit:
        raise ValueError(f"not a period: {period!r}")
    return int(m[1] or 1) * unit


def round_time(ts: Column, interval: int | str) -> Column:
    """Nearest grid stamp; the exact middle rounds up."""
    step = seconds(interval) * 1_000_000
    shifted = F.unix_micros(ts.cast("timestamp")) + F.lit(step // 2)
    return F.timestamp_micros(shifted - F.pmod(shifted, F.lit(step)))


def floor_to(value: Column, step: int) -> Column:
    """Integer floor division that also holds below zero."""
    return ((value - F.pmod(value, F.lit(step))) / F.lit(step)).cast("bigint")


def join_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def parse_any(text: Column, formats: tuple[str, ...] = NOTE_TIME_FORMATS) -> Column:
    """First format that reads the text; separators are free, so is an ISO ``T``/``Z``."""
    plain = F.regexp_replace(F.trim(text), r"(?<=\d)T(?=\d)", " ")
    plain = F.regexp_replace(plain, r"Z$|\.\d+Z?$", "")
    plain = F.trim(F.regexp_replace(plain, r"[-/,._\s]+", " "))
    # the one-element array gives the cleaned text a name, so it is computed once and not per format
    read = F.transform(F.array(plain), lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats]))
    return F.get(read, 0)
