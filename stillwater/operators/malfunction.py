"""Reported malfunctions: open or closed time spans per site and sensor.

The records of a site are reduced to a step function (which kinds are in force from when to when) by
counting starts and ends, so overlapping and very long records never multiply rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import ensure_column, fold
from ..functions.text import matches
from ..functions.timegrid import floor_to
from ..plans.asof import States, attach_states
from ..plans.layout import Layout
from ..plans.scan import running
from ..schema import GENERAL_MALFUNCTION, MALFUNCTION_KINDS

KINDS = (*[k for k, _, _ in MALFUNCTION_KINDS], "general")
LABELS = (*[label for _, _, label in MALFUNCTION_KINDS], GENERAL_MALFUNCTION)
SEPARATOR = ";\n"


def malfunction_states(records: DataFrame, layout: Layout = Layout()) -> States:
    """What is in force from when to when: for the whole sonde, and for single sensors."""
    notes = F.col("notes")
    known = {kind: matches(notes, pattern) for kind, pattern, _ in MALFUNCTION_KINDS}
    general = F.lit(True)
    for hit in known.values():
        general = general & ~hit
    kinds = {**known, "general": general}
    whole_sonde = F.col("parameter").isNull() | known["burial"] | known["unsubmerged"]
    scopes = (
        F.when(whole_sonde, F.array(F.lit(None).cast("string")))
        .when(F.col("parameter") == "pH", F.array(F.lit("pH"), F.lit("ORP")))
        .otherwise(F.array("parameter"))
    )
    # whole seconds covered by the closed interval [start, end]
    start = F.ceil(F.unix_micros(F.col("start_dt").cast("timestamp")) / 1_000_000).cast("bigint")
    end = floor_to(F.unix_micros(F.col("end_dt").cast("timestamp")), 1_000_000) + 1
    rows = records.select(
        "site", F.explode(scopes).alias("scope"), start.alias("_start"), end.alias("_stop"),
        *[hit.cast("int").alias(k) for k, hit in kinds.items()],
    ).where(F.col("_stop").isNull() | (F.col("_stop") > F.col("_start")))
    edges = F.array_compact(F.array(
        F.struct(F.col("_start").alias("at"), F.lit(1).alias("sign")),
        F.when(F.col("_stop").isNotNull(), F.struct(F.col("_stop").alias("at"), F.lit(-1).alias("sign"))),
    ))
    steps = (
        rows.withColumn("_edge", F.explode(edges))
        .groupBy("site", F.coalesce("scope", F.lit("*")).alias("scope"), F.col("_edge.at").alias("_from"))
        .agg(*[F.sum(F.col(k) * F.col("_edge.sign")).alias(k) for k in KINDS])
        .withColumn("_bucket", floor_to(F.col("_from"), layout.slots * layout.step))
    )
    spans = running(steps, ("site", "scope"), "_from", "_bucket",
                    sums={f"{k}_on": F.col(k) for k in KINDS}, following="_to")
    sonde = F.col("scope") == "*"
    state = F.struct(*[(F.col(f"{k}_on") > 0).alias(k) for k in KINDS])
    spans = spans.select(
        "site", F.when(~sonde, F.col("scope")).alias("parameter"), "_from", "_to",
        F.when(sonde, state).alias("_sonde_state"), F.when(~sonde, state).alias("_sensor_state"))
    return [spans], {"_sonde_state": ("site",), "_sensor_state": ("site", "parameter")}


def malfunction_rules() -> list[tuple[str, Column]]:
    def on(kind: str) -> Column:
        return (F.coalesce(F.col(f"_sonde_state.{kind}"), F.lit(False))
                | F.coalesce(F.col(f"_sensor_state.{kind}"), F.lit(False)))
    return [(label, on(kind)) for kind, label in zip(KINDS, LABELS)]


def malfunction_flag(df: DataFrame, records: DataFrame, layout: Layout = Layout(),
                     bounds: DataFrame | None = None) -> DataFrame:
    """Write the reported malfunctions in force at each stamp to ``mal_flag``."""
    df = ensure_column(df, "mal_flag")
    df = attach_states(df, malfunction_states(records, layout), layout, bounds)
    mal = fold(F.col("mal_flag").cast("string"), malfunction_rules(), SEPARATOR)
    return df.withColumn("mal_flag", mal).drop("_sonde_state", "_sensor_state")
