import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stillwater import local_session  # noqa: E402

START = datetime(2024, 3, 1)
STEP = timedelta(minutes=15)


@pytest.fixture(scope="session")
def spark():
    session = local_session("stillwater-tests", cores=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(i, step=STEP):
    return START + i * step


def dtype(v):
    return {bool: "boolean", int: "int", float: "double", datetime: "timestamp"}.get(type(v), "string")


@pytest.fixture(scope="session")
def series(spark):
    """Rows from means and optional extra columns: one series on a 15-minute grid."""
    def make(means, site="bellvue", parameter="Turbidity", step=STEP, types=None, **extra):
        n = len(means)
        columns = {"mean": [None if m is None else float(m) for m in means], **extra}
        names = ["site", "parameter", "dt_round", *columns]
        rows = [(site, parameter, at(i, step), *[columns[c][i] for c in columns]) for i in range(n)]
        kinds = {"mean": "double", **(types or {})}
        schema = "site string, parameter string, dt_round timestamp, " + ", ".join(
            f"{c} {kinds.get(c) or next((dtype(v) for v in columns[c] if v is not None), 'string')}" for c in columns)
        assert len(names) == 3 + len(columns)
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture(scope="session")
def column():
    """Values of one column in time order."""
    def get(df, name):
        return [r[name] for r in df.select("dt_round", name).orderBy("dt_round").collect()]
    return get
