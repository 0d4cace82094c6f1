"""Seasonal thresholds: exact percentiles of groups of any size."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import join_per_group

GROUP = ("site", "parameter", "season")
SKETCH_ACCURACY = 10000
BRACKET = 20 / SKETCH_ACCURACY


SPLITS = 512  # parts that a bracket's different values are cut into before the last ones are ordered


def _values(df: DataFrame, keys: tuple[str, ...], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    # stamps part the rows of a hot group even where most of its values are equal
    parted = F.col("dt_round") if "dt_round" in df.columns else F.struct(*[c for c, _ in wanted.values()])
    return df.select(*keys, F.xxhash64(parted).alias("_part"), *[c.alias(f"_v_{n}") for n, (c, _) in wanted.items()])


def _brackets(values: DataFrame, keys: tuple[str, ...], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """Per group and quantile: the number of values, and two values that a mergeable sketch puts around the quantile."""
    sketches = []
    for n, (_, p) in wanted.items():
        v = F.col(f"_v_{n}")
        ends = F.percentile_approx(v, [max(p - BRACKET, 0.0), min(p + BRACKET, 1.0)], SKETCH_ACCURACY)
        sketches.append(F.struct(F.count(v).alias("n"), F.get(ends, 0).alias("lo"), F.get(ends, 1).alias("hi")).alias(f"_b_{n}"))
    return values.groupBy(*keys).agg(*sketches)


def _counted(values: DataFrame, brackets: DataFrame, keys: tuple[str, ...], wanted, between: tuple[str, str] | None = None) -> DataFrame:
    """Per group and quantile (``_q``) a row for each different value in the bracket and one for each side of it.

    With ``between`` (a lower and an upper quantile of the same column) another row, ``_q`` null, holds the deviations
    ``_d`` and their squares ``_dd`` of the values between the two brackets from the middle of the group.
    """
    hits = []
    for n in wanted:
        v, lo, hi = F.col(f"_v_{n}"), F.col(f"_b_{n}.lo"), F.col(f"_b_{n}.hi")
        side = F.when(v < lo, -1).when(v > hi, 1).otherwise(0)
        hits.append(F.when(v.isNotNull(), F.struct(F.lit(n).alias("q"), side.alias("side"), F.when(side == 0, v).alias("v"), v.alias("any"))))
    if between:
        low, high = between
        v = F.col(f"_v_{low}")
        inner = (v > F.col(f"_b_{low}.hi")) & (v < F.col(f"_b_{high}.lo"))
        hits.append(F.when(inner, F.struct(F.lit(None).cast("string").alias("q"), F.lit(0).alias("side"), F.lit(None).cast("double").alias("v"), v.alias("any"))))
        off = F.col("_h.any") - (F.col(f"_b_{low}.lo") + F.col(f"_b_{high}.hi")) / 2
        moments = [F.sum(F.when(F.col("_h.q").isNull(), off)).alias("_d"), F.sum(F.when(F.col("_h.q").isNull(), off * off)).alias("_dd")]
    return (
        join_per_group(values, brackets, keys, F.col("_part"))
        .withColumn("_h", F.explode(F.array_compact(F.array(*hits))))
        .groupBy(*keys, F.col("_h.q").alias("_q"), F.col("_h.side").alias("_side"), F.col("_h.v").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_h.any").alias("_least"), F.max("_h.any").alias("_most"), *(moments if between else []))
    )


def _ranked(counted: DataFrame, brackets: DataFrame, keys: tuple[str, ...], wanted) -> DataFrame:
    """Quantiles from the counts. Nothing orders a whole bracket: its different values are cut into parts at the points of
    another sketch, the parts' counts (a few hundred) are summed up, and only the parts that hold one of the two ranks
    a quantile lies between are ordered by value."""
    own = counted.where("_q IS NOT NULL")
    value = F.when(F.col("_side") < 0, F.col("_most")).when(F.col("_side") > 0, F.col("_least")).otherwise(F.col("_v"))
    group = [*keys, "_q"]
    points = own.where("_side = 0").groupBy(*group).agg(F.percentile_approx("_v", [i / SPLITS for i in range(1, SPLITS)], SKETCH_ACCURACY).alias("_points"))
    inside = join_per_group(own.where("_side = 0"), points, tuple(group), F.col("_v"))
    # first place among the sorted points that is not below the value
    cut = F.size(F.filter("_points", lambda x: x < F.col("_v")))
    parted = inside.withColumn("_part", cut).drop("_points").unionByName(own.where("_side <> 0").withColumn("_part", F.when(F.col("_side") < 0, -1).otherwise(SPLITS + 1)))
    parts = parted.groupBy(*group, "_part").agg(F.sum("_c").alias("_all"))
    upto = F.sum("_all").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    size = F.lit(None).cast("bigint")
    p = F.lit(None).cast("double")
    for n, (_, at) in wanted.items():
        size = F.when(F.col("_q") == n, F.col(f"_b_{n}.n")).otherwise(size)
        p = F.when(F.col("_q") == n, F.lit(float(at))).otherwise(p)
    sized = brackets.withColumn("_q", F.explode(F.array(*[F.lit(n) for n in wanted]))).select(*group, size.alias("_n"), p.alias("_p"))
    below = F.floor(F.col("_p") * (F.col("_n") - 1))
    # ranks count from 0; of the rows of a side only the one next to the bracket is known
    chosen = (parts.withColumn("_before", upto - F.col("_all")).join(sized, group).withColumns({"_low": below, "_high": F.least(below + 1, F.col("_n") - 1)})
              .where((F.col("_before") <= F.col("_high")) & (F.col("_before") + F.col("_all") > F.col("_low"))))
    rows = parted.join(chosen.drop("_all"), [*group, "_part"])
    in_part = Window.partitionBy(*group, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_last", F.col("_before") + F.sum("_c").over(in_part) - 1).withColumn("_first", F.col("_last") - F.col("_c") + 1)

    def at(rank: str) -> Column:
        known = F.when(F.col("_side") < 0, F.col(rank) == F.col("_last")).when(F.col("_side") > 0, F.col(rank) == F.col("_first")).otherwise(
            F.col(rank).between(F.col("_first"), F.col("_last")))
        return F.max(F.when(known, value))

    found = rows.groupBy(*group).agg(at("_low").alias("_a"), at("_high").alias("_z"), F.max(F.col("_p") * (F.col("_n") - 1) - F.col("_low")).alias("_w"))
    return found.select(*group, (F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_w")).alias("_value"))


def _one_row(found: DataFrame, brackets: DataFrame, keys: tuple[str, ...], names) -> DataFrame:
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == n, F.col("_value"))).alias(n) for n in names])
    return brackets.select(*keys).join(wide, list(keys), "left")


def exact_quantiles(df: DataFrame, keys: tuple[str, ...], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """Interpolated quantiles (the position is ``p * (n - 1)``), exact, without holding a group in memory.

    A mergeable sketch brackets each quantile first, twenty times as wide as its error bound allows. A second pass counts
    the different values inside the bracket and the rows on either side of it, of which it keeps the value next to the
    bracket; all that is combined before the shuffle. The two ranks a quantile lies between are then inside the bracket or
    next to it: the sketch is exact up to ``SKETCH_ACCURACY`` values, where a bracket may miss by one rank. The bracket's
    values are narrowed by counts once more (``_ranked``), so that what one task orders is some 10^-5 of a group.
    """
    values = _values(df, keys, wanted)
    brackets = _brackets(values, keys, wanted)
    return _one_row(_ranked(_counted(values, brackets, keys, wanted), brackets, keys, wanted), brackets, keys, wanted)


def threshold_table(df: DataFrame, lo: float = 0.01, hi: float = 0.99, approx: bool = False) -> DataFrame:
    """Per site, parameter and season: outer percentiles of the means and slopes, trimmed deviation.

    Needs ``season`` and ``slope_behind``, and reads its input twice: for the sketches, and for the counts. The deviation of
    the means strictly between the outer percentiles comes from the same counts: the values in the two brackets are known
    one by one, those between them by their sums. ``approx=True`` takes the sketch's percentiles instead.
    """
    mean, slope = F.col("mean"), F.col("slope_behind")
    wanted = {
        "t_mean01": (mean, lo),
        "t_mean99": (mean, hi),
        "t_slope_behind_01": (F.when(slope < 0, slope), lo),
        "t_slope_behind_99": (F.when(slope > 0, slope), hi),
    }
    if approx:
        table = df.groupBy(*GROUP).agg(
            *[F.percentile_approx(c, p, SKETCH_ACCURACY).alias(n) for n, (c, p) in wanted.items()])
        inner = (mean > F.col("t_mean01")) & (mean < F.col("t_mean99"))
        trimmed = join_per_group(df.select(*GROUP, "dt_round", "mean"), table.select(*GROUP, "t_mean01", "t_mean99"), GROUP, F.col("dt_round")).where(
            inner).groupBy(*GROUP).agg(F.stddev_samp("mean").alias("t_sd_0199"))
        return table.join(trimmed, list(GROUP)).select("season", "site", "parameter", *wanted, "t_sd_0199")

    values = _values(df, GROUP, wanted)
    brackets = _brackets(values, GROUP, wanted)
    counted = _counted(values, brackets, GROUP, wanted, between=("t_mean01", "t_mean99"))
    table = _one_row(_ranked(counted, brackets, GROUP, wanted), brackets, GROUP, wanted)
    ends = table.select(*GROUP, "t_mean01", "t_mean99").join(brackets.select(*GROUP, F.col("_b_t_mean01").alias("_low"), F.col("_b_t_mean99").alias("_high")), list(GROUP))
    known = join_per_group(counted.where("_q IS NULL OR (_side = 0 AND _q IN ('t_mean01', 't_mean99'))"), ends, GROUP, F.col("_v"))
    v = F.col("_v")
    # a value in both brackets counts once, by the lower one
    once = (F.col("_q") == "t_mean01") | (v > F.col("_low.hi")) | (v < F.col("_low.lo"))
    taken = known.where(F.col("_q").isNull() | (once & (v > F.col("t_mean01")) & (v < F.col("t_mean99"))))
    off = v - (F.col("_low.lo") + F.col("_high.hi")) / 2
    sums = taken.groupBy(*GROUP).agg(F.sum("_c").alias("_n"), F.sum(F.coalesce("_d", F.col("_c") * off)).alias("_s"), F.sum(F.coalesce("_dd", F.col("_c") * off * off)).alias("_ss"))
    spread = (F.col("_ss") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    trimmed = sums.select(*GROUP, F.when(F.col("_n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("t_sd_0199"))
    return table.join(trimmed, list(GROUP)).select("season", "site", "parameter", *wanted, "t_sd_0199")
