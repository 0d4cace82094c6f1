"""Neighbouring sites along a river."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import contains_any, ensure_column
from ..plans.layout import CHUNK, CLOCK, Frames, Layout, gather, spread
from ..schema import NETWORK_IGNORED


def network_edges(networks: DataFrame) -> DataFrame:
    """(site, up, down) from (network_name, network array[, network_order]).

    A site in several networks uses the one that bears its name, else the first. Sites alone in
    their network have no edges.
    """
    order = "network_order" if "network_order" in networks.columns else "network_name"
    placed = networks.select(
        "network_name", F.col(order).alias("_order"), "network", F.posexplode("network").alias("_pos", "site"),
    )
    pick = Window.partitionBy("site").orderBy(F.col("network_name") != F.col("site"), "_order", "_pos")
    return (
        placed.withColumn("_rank", F.row_number().over(pick)).where((F.col("_rank") == 1) & (F.size("network") > 1))
        .select(
            "site",
            F.when(F.col("_pos") > 0, F.get("network", F.col("_pos") - 1)).alias("up"),
            F.get("network", F.col("_pos") + 1).alias("down"),
        )
    )


def listeners(edges: DataFrame) -> DataFrame:
    """(site, heard_by): the sites that look at this one. As small as the network file."""
    pairs = edges.select("site", F.explode(F.array_compact(F.array("up", "down"))).alias("neighbour"))
    return pairs.groupBy(F.col("neighbour").alias("site")).agg(F.collect_set(pairs["site"]).alias("heard_by"))


def telling(flag: Column) -> Column:
    """A flag that says something about the water, not only about the sonde."""
    return flag.isNotNull() & ~contains_any(flag, NETWORK_IGNORED)


def with_reports(df: DataFrame, edges: DataFrame) -> DataFrame:
    """Add narrow copies of telling rows under each listening site; ``_own`` marks the real rows.

    One pass: only flagged rows are copied, and a copy holds nothing but its key.
    """
    heard = F.when(telling(F.col("flag")), F.col("heard_by"))
    none = F.array().cast("array<string>")
    sent = F.transform(F.coalesce(heard, none),
                       lambda s: F.struct(s.alias("site"), F.lit(False).alias("own")))
    kept = F.array(F.struct(F.col("site").alias("site"), F.lit(True).alias("own")))
    joined = df.join(listeners(edges), "site", "left").withColumn("_to", F.explode(F.concat(kept, sent)))
    own = F.col("_to.own")
    keys = ("parameter", "dt_round")
    return joined.select(
        F.col("_to.site").alias("site"), *keys, own.alias("_own"),
        *[F.when(own, F.col(c)).alias(c) for c in df.columns if c not in ("site", *keys)],
    )


def heard_at(*stamp: str) -> Column:
    return F.max((~F.col("_own")).cast("int")).over(Window.partitionBy(*stamp))


def auto_flag(frames: Frames, width: int, exempt: tuple[str, ...]) -> Column:
    """Clear a telling flag when a neighbour has one inside the full centred window."""
    first, last = -((width - 1) // 2), width // 2
    shared = (frames.count(first, last) == width) & (frames.total("_heard", first, last) > 0)
    clear = telling(F.col("flag")) & shared
    if exempt:
        clear = clear & ~F.col("parameter").isin(*exempt)
    return F.when(clear, F.lit(None).cast("string")).otherwise(F.col("flag"))


def spread_with_reports(df: DataFrame, edges: DataFrame, layout: Layout, before: int, after: int) -> DataFrame:
    """Chunked rows with ``_heard``: did a neighbour flag the same parameter at this stamp?"""
    df = with_reports(df, edges)
    if layout.gap_free:
        # placed by chunk at once: good for the stamps as well as for the frames that follow
        rows = spread(df, layout, before, after).repartition("site", "parameter", CHUNK)
        rows = rows.withColumn("_heard", heard_at("site", "parameter", CHUNK, CLOCK))
        return rows.where(F.col("_own")).drop("_own")
    df = df.withColumn("_heard", heard_at("site", "parameter", "dt_round")).where(F.col("_own")).drop("_own")
    return spread(df, layout, before, after)


def network_check(df: DataFrame, edges: DataFrame, layout: Layout = Layout(), width: int = 17,
                  exempt_parameters: tuple[str, ...] = ()) -> DataFrame:
    """Add ``auto_flag``: ``flag`` without what the up- or downstream neighbour sees at about the same time."""
    df = ensure_column(df, "flag").drop("auto_flag")
    rows = spread_with_reports(df, edges, layout, width // 2, width // 2)
    rows = rows.withColumn("auto_flag", auto_flag(Frames(), width, exempt_parameters))
    return gather(rows).drop("_heard")


__all__ = ["network_edges", "network_check", "listeners", "with_reports", "auto_flag", "spread_with_reports"]
