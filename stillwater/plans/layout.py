"""How a series is cut over tasks.

A series (site + parameter) can be arbitrarily long, and one of them may hold a large share of all
rows, so no window here is partitioned by the series alone. The rows are cut into chunks of a fixed
number of grid slots; the few rows that a neighbouring chunk needs to complete its frames travel
there as a halo. After the windows only each chunk's own rows are kept, so results do not depend on
the chunk size, and the work per task is bounded whatever the series length.

``gap_free=True`` says that every series has one row per grid stamp between its first and last one
(what ``pad_grid`` returns). Chunks then follow the clock, are the same for all parameters of a
site, and no extra pass is needed. Otherwise rows are numbered first (``number_rows``), so that
frames counted in rows stay exact across gaps.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.timegrid import floor_to, seconds
from ..schema import SERIES
from .scan import running

HALO_SHARE = 6
CHUNK, CORE, CLOCK, POSITION = "_chunk", "_core", "_clock", "_position"


@dataclass(frozen=True)
class Layout:
    interval: int | str = "15 minutes"
    gap_free: bool = False
    slots: int = 4096

    @property
    def step(self) -> int:
        return seconds(self.interval)

    def rows_in(self, period: int | str) -> int:
        """Most rows a period can span on the grid."""
        return -(-seconds(period) // self.step)

    def chunk_size(self, before: int, after: int) -> int:
        """Slots per chunk: large against the halo, so that copies stay a small share of the rows."""
        return max(self.slots, HALO_SHARE * (before + after))


class Frames:
    """Window frames inside one chunk of a series."""

    def __init__(self, *extra: str, keys: tuple[str, ...] = SERIES):
        self.keys = (*keys, CHUNK, *extra)
        self.ordered: WindowSpec = Window.partitionBy(*self.keys).orderBy(CLOCK)
        self.whole: WindowSpec = Window.partitionBy(*self.keys)

    @cache
    def rows(self, first: int, last: int) -> WindowSpec:
        return self.ordered.rowsBetween(first, last)

    @cache
    def upto(self, shift_seconds: int) -> WindowSpec:
        """All rows up to the clock plus ``shift_seconds``: grows with the row, so it costs O(1) per row."""
        return self.ordered.rangeBetween(Window.unboundedPreceding, shift_seconds)

    def total(self, value: Column | str, first: int, last: int) -> Column:
        """Sum over the rows ``first``..``last`` as a difference of two running sums (whole numbers only).

        Unlike a moving frame it costs the same for any width.
        """
        whole = Window.unboundedPreceding
        return (F.coalesce(F.sum(value).over(self.rows(whole, last)), F.lit(0))
                - F.coalesce(F.sum(value).over(self.rows(whole, first - 1)), F.lit(0)))

    @cache
    def count(self, first: int, last: int) -> Column:
        return self.total(F.lit(1), first, last)

    def lag(self, c: Column | str, n: int = 1) -> Column:
        return F.lag(c, n).over(self.ordered)

    def lead(self, c: Column | str, n: int = 1) -> Column:
        return F.lead(c, n).over(self.ordered)


def clock(time_col: str = "dt_round") -> Column:
    return F.unix_seconds(F.col(time_col))


def with_positions(df: DataFrame, layout: Layout, keys: tuple[str, ...] = SERIES) -> DataFrame:
    """Dense row number per series, without ordering a whole series in one task."""
    span = layout.slots * layout.step
    df = df.withColumn("_bucket", floor_to(F.col(CLOCK), span))
    numbered = running(df, keys, CLOCK, "_bucket", sums={POSITION: F.lit(1)})
    return numbered.drop("_bucket").withColumn(POSITION, F.col(POSITION) - 1)


def number_rows(df: DataFrame, layout: Layout) -> DataFrame:
    """Number the rows of every series once, in ``_position``, for a chain of operators.

    Without it each operator on series with gaps numbers its input anew, which reads that input
    twice. The numbers must stay dense: number again after taking rows away.
    """
    return with_positions(df.withColumn(CLOCK, clock()), layout).drop(CLOCK)


def spread(df: DataFrame, layout: Layout, before: int, after: int, time_col: str = "dt_round") -> DataFrame:
    """Copy each row to its chunk and to the chunks that need it within ``before``/``after`` rows."""
    size = layout.chunk_size(before, after)
    numbered = POSITION in df.columns
    df = df.withColumn(CLOCK, clock(time_col))
    if layout.gap_free:
        slot = floor_to(F.col(CLOCK), layout.step)
    else:
        df = df if numbered else with_positions(df, layout)
        slot = F.col(POSITION)
    home = floor_to(slot, size)
    offset = F.pmod(slot, F.lit(size))
    homes = F.array(
        F.struct(home.alias("c"), F.lit(True).alias("own")),
        F.when(offset >= size - before, F.struct((home + 1).alias("c"), F.lit(False).alias("own"))),
        F.when(offset < after, F.struct((home - 1).alias("c"), F.lit(False).alias("own"))),
    )
    helpers = ("_home",) if numbered else ("_home", POSITION)
    return (
        df.withColumn("_home", F.explode(F.array_compact(homes)))
        .withColumns({CHUNK: F.col("_home.c"), CORE: F.col("_home.own")})
        .drop(*helpers)
    )


def gather(df: DataFrame) -> DataFrame:
    """Drop the halo copies and the helper columns."""
    return df.where(F.col(CORE)).drop(CHUNK, CORE, CLOCK)


def over_series(df: DataFrame, layout: Layout, before: int, after: int,
                build: Callable[[DataFrame, Frames], DataFrame]) -> DataFrame:
    """Run ``build`` on chunked series with room for frames of ``before``/``after`` rows."""
    return gather(build(spread(df, layout, before, after), Frames()))
