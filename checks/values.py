"""Fixed values that must equal the data's vocabulary. The SQL states them for itself, so that a slip in the package's list shows."""

MALFUNCTION_KINDS = (
    ("burial", "buried|burial|bury|sediment|roots", "reported sonde burial"),
    ("biofouling", "grime|gunk|drift|biofoul|biofilm", "reported sensor biofouling"),
    ("depth", "improper level calibration", "reported depth calibration malfunction"),
    ("unsubmerged", "not submerged", "reported sonde unsubmerged"),
)

NETWORK_IGNORED = (
    "drift",
    "DO interference",
    "repeat",
    "sonde not employed",
    "frozen",
    "unsubmerged",
    "missing data",
    "site visit",
    "sv window",
    "sensor malfunction",
    "burial",
    "sensor biofouling",
    "improper level cal",
    "sonde moved",
)

SUSPECT_EXCLUDED = (
    "reported sonde not employed",
    "sonde not employed",
    "missing data",
    "site visit",
    "sv window",
    "site visit window",
    "reported sonde burial",
    "reported sensor biofouling",
    "reported depth calibration malfunction",
    "reported sensor malfunction",
)

TIDY_RULES = (
    ("site visit", "site visit"),
    ("sv window", "site visit window"),
    ("reported sonde not employed", "sonde not employed"),
    ("reported sensor malfunction", "reported sensor malfunction"),
    ("reported sonde burial", "reported sonde burial"),
    ("reported sensor biofouling", "reported sensor biofouling"),
    ("frozen", "frozen"),
)

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

DEFAULT_SITES = (
    "bellvue",
    "salyer",
    "udall",
    "riverbend",
    "cottonwood",
    "elc",
    "archery",
    "riverbluffs",
)
