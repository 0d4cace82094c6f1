"""Schemas and the fixed vocabulary: labels, site renames, parameters, seasons."""
from __future__ import annotations

from pyspark.sql import types as T

SERIES = ("site", "parameter")

RAW_READING = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("units", T.StringType()),
])

THRESHOLDS = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("t_mean01", T.DoubleType()),
    T.StructField("t_mean99", T.DoubleType()),
    T.StructField("t_slope_behind_01", T.DoubleType()),
    T.StructField("t_slope_behind_99", T.DoubleType()),
    T.StructField("t_sd_0199", T.DoubleType()),
])

SENSOR_SPEC = T.StructType([
    T.StructField("parameter", T.StringType()),
    T.StructField("spec_min", T.DoubleType()),
    T.StructField("spec_max", T.DoubleType()),
])

NETWORKS = T.StructType([
    T.StructField("network_name", T.StringType()),
    T.StructField("network", T.StringType()),
    T.StructField("network_order", T.LongType()),
])

MALFUNCTIONS = T.StructType([
    T.StructField("start_dt", T.TimestampType()),
    T.StructField("end_dt", T.TimestampType()),
    T.StructField("site", T.StringType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("notes", T.StringType()),
])

TRACKER = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("site_parameter", T.StringType()),
    T.StructField("failure_count", T.IntegerType()),
    T.StructField("last_success", T.TimestampType()),
    T.StructField("auto_disabled", T.BooleanType()),
    T.StructField("try_again", T.BooleanType()),
])

SOURCE_PAGE = T.StructType([
    T.StructField("locationId", T.StringType()),
    T.StructField("parameters", T.ArrayType(T.StructType([
        T.StructField("parameterId", T.StringType()),
        T.StructField("unitId", T.StringType()),
        T.StructField("customParameter", T.BooleanType()),
        T.StructField("readings", T.ArrayType(T.StructType([
            T.StructField("timestamp", T.LongType()),
            T.StructField("value", T.DoubleType()),
        ]))),
    ]))),
])

FRIENDLY_NAMES = T.StructType([
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("units", T.MapType(T.StringType(), T.StringType())),
])

SITE_LOCATION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("gps", T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ])),
])

# ---------------------------------------------------------------------------
# They must read exactly like this for results to agree.
# ---------------------------------------------------------------------------

# old name contained in a site -> new name, first match wins
SITE_RENAMES = (
    ("tamasag", "bellvue"),
    ("legacy", "salyer"),
    ("lincoln", "udall"),
    ("timberline", "riverbend"),
    ("prospect", "cottonwood"),
    ("boxelder", "elc"),
    ("archery", "archery"),
    ("river bluffs", "riverbluffs"),
    ("mountaincampus", "mtncampus"),
)

DEFAULT_SITES = ("bellvue", "salyer", "udall", "riverbend", "cottonwood", "elc", "archery", "riverbluffs")

SITE_DISPLAY = (
    ("bellvue", "Bellvue"),
    ("cottonwood", "Cottonwood Hollow"),
    ("salyer", "Salyer"),
    ("udall", "Udall"),
    ("riverbend", "Riverbend Ponds"),
    ("elc", "ELC"),
    ("archery", "Archery"),
    ("riverbluffs", "River Bluffs"),
)

SEASONS = (
    ("winter_baseflow", (12, 1, 2, 3, 4)),
    ("snowmelt", (5, 6)),
    ("monsoon", (7, 8, 9)),
    ("fall_baseflow", (10, 11)),
)

SENSOR_PARAMETERS = (
    "Battery Level", "Baro", "Chl-a Fluorescence", "Depth", "DO", "External Voltage",
    "ORP", "pH", "Specific Conductivity", "Temperature", "Turbidity",
)

FIELD_PARAMETER_NAMES = (
    ("Chlorophyll a", "Chl-a Fluorescence"),
    ("RDO", "DO"),
    ("Conductivity", "Specific Conductivity"),
)

EXCLUDED_EQUIPMENT = ("vulink", "virridy")
EXCLUDED_PARAMETER = "FDOM Fluorescence"
DRIFT_PARAMETERS = ("Turbidity", "Chl-a Fluorescence")

NOT_EMPLOYED = "sonde not employed"
SITE_VISIT = "site visit"
SV_WINDOW = "sv window"
MISSING = "missing data"
DO_INTERFERENCE = "DO interference"
BURIAL = "Possible burial"
REPEATED = "repeated value"
DRIFT = "drift"
OUT_OF_SPEC = "outside of sensor specification range"
OUT_OF_SEASON = "outside of seasonal range"
SLOPE = "slope violation"
FROZEN = "frozen"
UNSUBMERGED = "sonde unsubmerged"
SUSPECT = "suspect data"

# category -> (pattern over the lower-cased notes, label)
MALFUNCTION_KINDS = (
    ("burial", "buried|burial|bury|sediment|roots", "reported sonde burial"),
    ("biofouling", "grime|gunk|drift|biofoul|biofilm", "reported sensor biofouling"),
    ("depth", "improper level calibration", "reported depth calibration malfunction"),
    ("unsubmerged", "not submerged", "reported sonde unsubmerged"),
)
GENERAL_MALFUNCTION = "reported sensor malfunction"

# flags that a neighbour site neither confirms nor clears
NETWORK_IGNORED = (
    "drift", "DO interference", "repeat", "sonde not employed", "frozen", "unsubmerged",
    "missing data", "site visit", "sv window", "sensor malfunction", "burial",
    "sensor biofouling", "improper level cal", "sonde moved",
)

# flags that do not make their surroundings suspect
SUSPECT_EXCLUDED = (
    "reported sonde not employed", "sonde not employed", "missing data", "site visit",
    "sv window", "site visit window", "reported sonde burial", "reported sensor biofouling",
    "reported depth calibration malfunction", "reported sensor malfunction",
)

# (contained text, whole flag it becomes), first match wins
TIDY_RULES = (
    ("site visit", "site visit"),
    ("sv window", "site visit window"),
    ("reported sonde not employed", "sonde not employed"),
    ("reported sensor malfunction", "reported sensor malfunction"),
    ("reported sonde burial", "reported sonde burial"),
    ("reported sensor biofouling", "reported sensor biofouling"),
    ("frozen", "frozen"),
)

# Spark patterns after separators became single blanks (date, compact and US field styles)
NOTE_TIME_FORMATS = (
    "yyyy M d H:m:s", "yyyy M d H:m", "yyyy M d",
    "yyyyMMdd H:m:s",
    "MMddyy H:m", "M d yy H:m",
    "MMddyyyy H:m", "M d yyyy H:m",
    "MMMddyy H:m", "MMM d yy H:m", "MMM d yyyy H:m",
)
