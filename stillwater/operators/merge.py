"""Joining new data with the archive."""
from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import ensure_column
from ..functions.timegrid import seconds
from ..plans.joins import join_per_group
from ..schema import SERIES

KEY = (*SERIES, "dt_round")
COMPARED = ("mean", "auto_flag", "mal_flag")


def _checked(incoming: DataFrame | None, history: DataFrame | None, period) -> int:
    if period is None:
        raise ValueError("a period is required")
    if incoming is None and history is None:
        raise ValueError("no data to merge")
    if incoming is None:
        raise ValueError("no incoming data to merge")
    if history is None:
        warnings.warn("no historical data to merge with", stacklevel=3)
    return seconds(period)


def _cuts(history: DataFrame, period: int) -> DataFrame:
    """Per series, where its trailing period begins (``_cut``)."""
    return history.groupBy(*SERIES).agg((F.max(F.unix_seconds("dt_round")) - period).alias("_cut"))


def _with_cut(history: DataFrame, cuts: DataFrame, how: str = "inner") -> DataFrame:
    return join_per_group(history, cuts, SERIES, F.col("dt_round"), how)


def _recent() -> Column:
    return F.unix_seconds("dt_round") >= F.col("_cut")


def _from(df: DataFrame, seconds_utc: Column) -> DataFrame:
    """Rows from a moment on; where the rows are partitioned by ``year``, older years are not read."""
    if "year" in df.columns:
        df = df.where(F.col("year") >= F.year(F.timestamp_seconds(seconds_utc)))
    return df.where(F.unix_seconds("dt_round") >= seconds_utc)


def trailing_history(history: DataFrame, period: int | str, of: DataFrame | None = None) -> DataFrame:
    """The last ``period`` of every series, or of those that ``of`` has rows of.

    The cuts come from three narrow columns; of the rest only what lies behind the earliest cut is read.
    """
    cuts = _cuts(history, seconds(period))
    if of is not None:
        cuts = cuts.join(of.select(*SERIES).distinct(), list(SERIES), "left_semi")
    if "year" in history.columns:  # elsewhere there is nothing to prune, and the cuts would be planned once more
        history = _from(history, cuts.select(F.min("_cut")).scalar())
    return _with_cut(history, cuts).where(_recent()).drop("_cut")


def merge_preflag(incoming: DataFrame, history: DataFrame | None, period: int | str, cut: bool = False) -> DataFrame:
    """Trailing history and what is new, ready to be flagged together.

    Series without incoming rows are left out; history keeps its flags and wins on equal stamps. ``cut`` says that
    ``history`` holds the trailing period of those series alone (``trailing_rows`` of an archive with an index).
    """
    period = _checked(incoming, history, period)
    new = ensure_column(incoming, "flag").withColumn("flag", F.col("flag").cast("string"))
    new = new.withColumn("historical", F.lit(False))
    if history is None:
        return new
    past = (
        (history if cut else trailing_history(history, period, of=incoming))
        .withColumn("historical", F.lit(True))
        .withColumn("flag", F.col("auto_flag").cast("string"))
        .drop("sonde_moved", *({"year"} - set(new.columns)))
    )
    return past.unionByName(new.join(past.select(*KEY), list(KEY), "left_anti"), allowMissingColumns=True)


def merge_archive(flagged: DataFrame, history: DataFrame | None, period: int | str, cuts: DataFrame | None = None) -> DataFrame:
    """The new archive: older history, all flagged rows, and series that had no new data.

    A history row goes only if it is known to be replaced: it lies in the trailing period of a series with new rows,
    or a new row has its key (a late reading). Rows without site, parameter or stamp stay. Running it twice with the
    same input gives the same archive. ``cuts`` tells where the trailing period of each series with new rows begins
    (``_cut``, seconds), where that is known without reading the history.
    """
    period = _checked(flagged, history, period)
    new = flagged.withColumn("historical", F.lit(True))
    if history is None:
        return new
    history = ensure_column(history, "historical").withColumn("historical", F.col("historical").cast("boolean"))
    if cuts is None:
        touched = flagged.select(*SERIES).distinct().withColumn("_touched", F.lit(True))
        cuts = _cuts(history, period).join(touched, list(SERIES), "left")
    else:
        cuts = cuts.withColumn("_touched", F.lit(True))
    old = (
        _with_cut(history, cuts, "left")
        .where(~F.coalesce(F.col("_touched") & _recent(), F.lit(False)))
        .withColumn("historical", F.when(F.col("_touched"), F.lit(True)).otherwise(F.col("historical")))
        .drop("_cut", "_touched")
        .join(new.select(*KEY).distinct(), list(KEY), "left_anti")
    )
    return old.unionByName(new, allowMissingColumns=True)


def overlap_changes(flagged: DataFrame, history: DataFrame, period: int | str,
                    compared: tuple[str, ...] = COMPARED) -> DataFrame:
    """Series whose overlap with the archive came out differently this time."""
    shared = [c for c in compared if c in flagged.columns and c in history.columns]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*KEY, F.struct(*shared).alias(name))

    before = side(trailing_history(history, period, of=flagged), "_before")
    after = side(flagged.where(F.col("historical")), "_after")
    both = before.join(after, list(KEY), "full")
    return both.where(~F.col("_before").eqNullSafe(F.col("_after"))).groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("changed_rows"))


def recent(df: DataFrame, days: int = 45) -> DataFrame:
    """The archive's last days, counted back from its newest stamp."""
    last = df
    if "year" in df.columns:
        last = df.where(F.col("year") == df.select(F.max("year")).scalar())
    newest = last.select(F.max(F.unix_seconds("dt_round"))).scalar()
    return _from(df, newest - int(days) * 86_400)
