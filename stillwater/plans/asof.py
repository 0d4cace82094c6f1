"""As-of attachment: every reading gets the state that is in force at its stamp.

States are half-open spans ``[_from, _to)`` in seconds, disjoint per key, ``_to`` NULL while still in
force. Each span is copied to the time chunks it touches, so a reading finds its state inside its own
chunk however long ago that state began. Nothing is paired row by row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import floor_to
from .layout import CHUNK, CLOCK, CORE, Layout, clock, gather, spread


def time_bounds(df: DataFrame, time_col: str = "dt_round") -> DataFrame:
    """First and last stamp in seconds, one row."""
    return df.agg(F.min(clock(time_col)).alias("_lo"), F.max(clock(time_col)).alias("_hi"))


def chunked_states(spans: DataFrame, bounds: DataFrame, layout: Layout, before: int, after: int) -> DataFrame:
    """One row per state and touched chunk, limited to the time range of the readings."""
    step, size = layout.step, layout.chunk_size(before, after)
    span = size * step
    # one subquery for both ends, so the readings are looked through once
    spans = spans.withColumn("_range", bounds.select(F.struct("_lo", "_hi")).scalar())
    beyond = F.col("_range._hi") + 1
    begin = F.greatest(F.col("_from"), F.col("_range._lo"))
    end = F.least(F.coalesce(F.col("_to"), beyond), beyond)
    chunks = F.sequence(floor_to(F.col("_begin") - after * step, span), floor_to(F.col("_end") + before * step, span))
    return (
        spans.withColumns({"_begin": begin, "_end": end}).where(F.col("_end") > F.col("_begin"))
        .withColumns({CHUNK: F.explode(chunks), CLOCK: F.col("_from")})
        .drop("_begin", "_end", "_to", "_from", "_range")
    )


def latest(state: str, *keys: str) -> Column:
    """State of the latest event row at or before the row's clock, within its chunk."""
    window = (
        Window.partitionBy(*keys, CHUNK).orderBy(CLOCK)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.last(state, ignorenulls=True).over(window)


States = tuple[list[DataFrame], dict[str, tuple[str, ...]]]


def attach_states(df: DataFrame, states: States, layout: Layout, bounds: DataFrame | None = None) -> DataFrame:
    """Add one struct column per state.

    ``states``: frames of spans (their keys, ``_from``, ``_to`` and the state columns they set), and
    the keys by which each state column is looked up.
    """
    by_clock = Layout(layout.interval, gap_free=True, slots=layout.slots)
    bounds = time_bounds(df) if bounds is None else bounds
    rows = spread(df, by_clock, 0, 0)
    return gather(resolve_states(with_events(rows, states, bounds, by_clock, 0, 0), states))


def with_events(rows: DataFrame, states: States, bounds: DataFrame, layout: Layout, before: int, after: int) -> DataFrame:
    """Chunked rows plus event rows (marked by ``_core`` NULL), one exchange for both."""
    for spans in states[0]:
        rows = rows.unionByName(chunked_states(spans, bounds, layout, before, after), allowMissingColumns=True)
    return rows.repartition("site", CHUNK)


def resolve_states(rows: DataFrame, states: States) -> DataFrame:
    # site-wide windows first: the order by series is then kept for what follows
    by_keys: dict[tuple[str, ...], list[str]] = {}
    for name, keys in states[1].items():
        by_keys.setdefault(keys, []).append(name)
    for keys in sorted(by_keys, key=len):
        rows = rows.withColumns({name: latest(name, *keys) for name in by_keys[keys]})
    return rows.where(F.col(CORE).isNotNull())
