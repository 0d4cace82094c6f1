"""Field notes: cleaning, projections, and their attachment to readings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import ensure_column
from ..functions.text import matches, replace_first, standard_site
from ..functions.timegrid import floor_to, join_stamp, parse_any, round_time
from ..plans.asof import States, attach_states
from ..plans.layout import Layout
from ..plans.scan import running
from ..schema import FIELD_PARAMETER_NAMES, SENSOR_PARAMETERS

OTHER = "Other (please specify)"
OTHER_COLUMNS = ("site_other", "visit_type_other", "other_which_sensor_malfunction", "photos_downloaded_other")

# fixed values: the published column names
SENSOR_NOTE_COLUMNS = (
    "site", "crew", "dt_round", "sonde_employed", "sensors_cleaned", "wiper_working", "rdo_cap_condition",
    "rdo_cap_replaced", "ph_junction_replaced", "cals_performed", "cal_report_collected", "sonde_moved",
    "sensor_malfunction", "sensor_pulled", "sensor_deployed", "sensor_swapped_notes", "visit_type", "dt_join",
    "start_dt", "end_dt", "date", "visit_comments", "photos_downloaded", "field_season", "last_site_visit",
)


def clean_notes(raw: DataFrame, interval: int | str = "15 minutes") -> DataFrame:
    """Parse times, fold the free-text "other" answers in, and round the visit to the grid."""
    text = ("site", "visit_type", "which_sensor_malfunction", "photos_downloaded", "malfunction_end_dt", "end_dt",
            "sn_removed", "sn_deployed", *OTHER_COLUMNS)
    for name in text:
        raw = ensure_column(raw, name)

    def with_other(name: str, other: str) -> Column:
        c = F.col(name)
        return F.when(c.contains("Other"), replace_first(c, OTHER, F.col(other).cast("string"))).otherwise(c)

    df = raw.withColumns({
        "start_dt": parse_any(F.col("start_dt").cast("string")),
        "end_dt": parse_any(F.col("end_dt").cast("string")),
        "malfunction_end_dt": parse_any(F.col("malfunction_end_dt").cast("string")),
        "sensor_pulled": F.col("sn_removed").cast("string"),
        "sensor_deployed": F.col("sn_deployed").cast("string"),
        "site": F.when(F.col("site") == OTHER, F.lower(F.replace(F.col("site_other"), F.lit(" "), F.lit(""))))
        .otherwise(F.col("site")),
        "visit_type": replace_first(F.col("visit_type"), "???", "Sensor Calibration or Check"),
        "which_sensor_malfunction": with_other("which_sensor_malfunction", "other_which_sensor_malfunction"),
        "photos_downloaded": F.when(F.col("photos_downloaded") == OTHER, F.col("photos_downloaded_other"))
        .otherwise(F.col("photos_downloaded")),
    })
    return df.withColumns({
        "visit_type": with_other("visit_type", "visit_type_other"),
        "date": F.to_date("start_dt"),
        "dt_round": round_time(F.col("start_dt"), interval),
    }).drop(*OTHER_COLUMNS)


def sensor_notes(notes: DataFrame) -> DataFrame:
    """Routine sensor visits (malfunction reports aside) with the sonde's status after the visit."""
    change, pulled = F.col("sensor_change"), F.col("sensor_pulled")
    for name in SENSOR_NOTE_COLUMNS:
        if name not in ("sonde_employed", "sensor_swapped_notes", "dt_join", "field_season", "last_site_visit"):
            notes = ensure_column(notes, name, dtype="boolean" if name == "sonde_moved" else "string")
    swap = F.format_string("SN Removed: %s SN Deployed: %s", F.coalesce(pulled, F.lit("NA")),
                           F.coalesce(F.col("sensor_deployed"), F.lit("NA")))
    return (
        notes.where(matches(F.col("visit_type"), "sensor") & ~matches(F.col("visit_type"), "sensor malfunction"))
        .withColumns({
            "sonde_employed": F.when(change == "Pulled", 1).when(change == "Deployed", 0),
            "sensor_swapped_notes": F.when((change == "Pulled") & pulled.isNotNull(),
                                           F.concat(F.lit("SN Removed: "), pulled))
            .when(change == "Swapped", swap).when(change == "Deployed", F.col("sensor_deployed")),
            "dt_join": join_stamp(F.col("dt_round")),
            "field_season": F.year("dt_round"),
            "last_site_visit": F.col("dt_round"),
            "date": F.col("date").cast("string"),
        })
        .select(*SENSOR_NOTE_COLUMNS)
    )


def malfunction_notes(notes: DataFrame) -> DataFrame:
    """Malfunction reports, one row per reported sensor under its standard name."""
    for name in ("malfunction_end_dt", "which_sensor_malfunction", "visit_comments"):
        notes = ensure_column(notes, name)
    parameter = F.col("parameter")
    standard = parameter
    for field, name in FIELD_PARAMETER_NAMES:
        standard = F.when(parameter == field, F.lit(name)).otherwise(standard)
    return (
        notes.where(matches(F.col("visit_type"), "sensor malfunction"))
        .select(
            "start_dt", F.col("malfunction_end_dt").alias("end_dt"),
            F.when(F.col("site") == "river bluffs", F.lit("riverbluffs")).otherwise(F.col("site")).alias("site"),
            F.explode_outer(F.split("which_sensor_malfunction", ", ")).alias("parameter"),
            F.col("visit_comments").alias("notes"),
        )
        .withColumn("parameter", standard)
        .where(parameter.isNull() | parameter.isin(*SENSOR_PARAMETERS))
    )


def cleaning_notes(notes: DataFrame) -> DataFrame:
    """Readings before and after cleaning."""
    measured = [c for part in ("post_clea", "pre_clea") for c in notes.columns if part in c.lower()]
    return notes.select("start_dt", "dt_round", "date", "site", "sensors_cleaned", *measured)


# --- attachment ------------------------------------------------------------

CARRIED = {"sonde_employed": "int", "last_site_visit": "timestamp", "sensor_malfunction": "string"}
AT_VISIT = {"sonde_moved": "boolean", "visit_comments": "string", "cals_performed": "string"}


def note_states(notes: DataFrame, layout: Layout = Layout()) -> States:
    """Per site, what is known from each note until the next one.

    Notes of one site at one stamp count as one note (later starts win, moved if any says so), so a
    reading is never doubled.
    """
    for name, dtype in {**CARRIED, **AT_VISIT}.items():
        notes = ensure_column(notes, name, dtype=dtype)
    rank = F.coalesce(F.col("start_dt").cast("timestamp"), F.col("dt_round")) if "start_dt" in notes.columns \
        else F.col("dt_round")

    def newest(name: str) -> Column:
        # ties on the start are settled by the value itself, so reruns agree
        c = F.col(name)
        return F.max(F.when(c.isNotNull(), F.struct(rank.alias("at"), c.alias("v"))))["v"].alias(name)

    merged = (
        notes.where(F.col("dt_round").isNotNull())
        .groupBy(standard_site(F.col("site")).alias("site"), "dt_round")
        .agg(*[newest(c) for c in CARRIED], F.max("sonde_moved").alias("sonde_moved"),
             newest("visit_comments"), newest("cals_performed"))
        .withColumn("_from", F.unix_seconds("dt_round"))
        .withColumn("_bucket", floor_to(F.col("_from"), layout.slots * layout.step))
    )
    lasts = {f"{c}_now": F.col(c) for c in CARRIED}
    spans = running(merged, ("site",), "_from", "_bucket", lasts=lasts, following="_to")
    state = F.struct(
        *[F.col(f"{c}_now").cast(t).alias(c) for c, t in CARRIED.items()],
        *[F.col(c).cast(t).alias(c) for c, t in AT_VISIT.items()],
        F.col("dt_round").alias("noted_at"),
    )
    return [spans.select("site", "_from", "_to", state.alias("_note_state"))], {"_note_state": ("site",)}


def note_columns(df: DataFrame) -> DataFrame:
    """Unfold the attached state. Before the first visit a sonde counts as not employed."""
    state = F.col("_note_state")
    here = state["noted_at"] == F.col("dt_round")
    visit = state["last_site_visit"]
    return df.withColumns({
        "last_site_visit": visit,
        "sonde_employed": F.when(visit.isNull(), 1).otherwise(F.coalesce(state["sonde_employed"], F.lit(0))),
        "sensor_malfunction": state["sensor_malfunction"],
        **{c: F.when(here, state[c]) for c in AT_VISIT},
    }).drop("_note_state")


def attach_field_notes(df: DataFrame, notes: DataFrame, layout: Layout = Layout(),
                       bounds: DataFrame | None = None) -> DataFrame:
    """Status from the latest note at or before each stamp; visit details at the visit's own stamp.

    ``bounds`` (one row of _lo, _hi) spares a pass over the readings that finds their time range.
    """
    df = df.drop(*CARRIED, *AT_VISIT)
    return note_columns(attach_states(df, note_states(notes, layout), layout, bounds))


def newest_first(notes: DataFrame) -> DataFrame:
    """Notes for reading: the latest visit on top, ties by site, notes without a time last."""
    return notes.orderBy(F.col("start_dt").desc_nulls_last(), "site")
