"""Running values over keys of any size.

A running sum (or last known value) over one key needs all rows before it. Instead of ordering the
whole key in one task, rows are cut into time buckets: each bucket is reduced to one row, the
bucket rows are scanned, and what precedes a bucket is joined back to its rows. The scan sees one
row per key and bucket, so its size is set by the calendar, not by the number of rows: a century of
one-second data in buckets of 4096 slots is 770 thousand small rows per key.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, keys: tuple[str, ...], order: str, bucket: str, *,
            sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None,
            following: str | None = None) -> DataFrame:
    """Add running sums, last non-NULL values and the next order value per key.

    ``bucket`` must rise with ``order``. Sums and lasts include the current row; ``following`` names
    a column for the next row's ``order`` value.
    """
    sums, lasts = sums or {}, lasts or {}
    part = [*keys, bucket]
    staged = df.withColumns({f"_in_{n}": value for n, value in {**sums, **lasts}.items()})

    totals = staged.groupBy(*part).agg(
        F.min(order).alias("_first"),
        *[F.sum(f"_in_{n}").alias(f"_t_{n}") for n in sums],
        *[F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), F.col(order))).alias(f"_t_{n}")
          for n in lasts],
    )
    carried = _carry(totals, keys, bucket, list(sums), list(lasts))

    local = Window.partitionBy(*part).orderBy(order)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    out = staged.join(carried, part, "left")
    added = {n: F.coalesce(F.sum(f"_in_{n}").over(upto), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in sums}
    added |= {n: F.coalesce(F.last(f"_in_{n}", ignorenulls=True).over(upto), F.col(f"_c_{n}")) for n in lasts}
    if following:
        added[following] = F.coalesce(F.lead(order).over(local), F.col("_c_next"))
    out = out.withColumns(added)
    helpers = [f"_in_{n}" for n in (*sums, *lasts)] + [f"_c_{n}" for n in (*sums, *lasts)]
    return out.drop(*helpers, "_c_next")


def _carry(totals: DataFrame, keys: tuple[str, ...], bucket: str, sums: list[str], lasts: list[str]) -> DataFrame:
    """What lies before each bucket, and the first order value after it."""
    order = Window.partitionBy(*keys).orderBy(bucket)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *keys, bucket, F.lead("_first").over(order).alias("_c_next"),
        *[F.sum(f"_t_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_t_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts],
    )
