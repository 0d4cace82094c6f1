import numpy as np
import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.operators import signal
from stillwater.operators.signal import spline_at

from conftest import at

X = None


def test_linear_gaps(series, column):
    given = [X, 1, X, 3, X, X, X, X, 8, X, X, X, X, X, 14, X]
    got = column(sw.interpolate_gaps(series(given)), "mean_filled")
    assert got == [X, 1, 2, 3, 4, 5, 6, 7, 8, X, X, X, X, X, 14, X]
    assert column(sw.interpolate_gaps(series(given, parameter="DO")), "mean_filled") == [X] * 16
    with pytest.raises(ValueError):
        sw.interpolate_gaps(series(given), method="cubic")
    with pytest.raises(TypeError):
        sw.interpolate_gaps(series(given).withColumn("dt_round", F.col("dt_round").cast("string")))
    with pytest.warns(UserWarning, match="equally spaced"):
        sw.interpolate_gaps(series(given).where("minute(dt_round) <> 30"), check_spacing=True)


def test_spline_reproduces_a_cubic():
    x = np.array([0, 1, 2, 4, 5, 7, 9, 10.0])
    at = np.array([-1, 0.5, 3, 6, 8, 11])
    cubic = np.poly1d([0.3, -2, 1, 5])
    assert np.allclose(spline_at(x, cubic(x), at), cubic(at))
    assert np.allclose(spline_at(x[:3], x[:3] ** 2, at[1:3]), at[1:3] ** 2)
    assert np.allclose(spline_at(x[:2], 2 * x[:2], at), 2 * at)
    assert np.allclose(spline_at(x[:1], x[:1] + 4, at), 4) and np.isnan(spline_at(x[:0], x[:0], at)).all()


def test_spline_is_smooth_and_interpolates():
    r = np.random.default_rng(2)
    x = np.cumsum(r.uniform(0.5, 3, 40))
    y = r.normal(size=40)
    assert np.allclose(spline_at(x, y, x), y)
    for order in (1, 2):  # derivatives agree on both sides of the knots
        h = 1e-3
        stencil = {1: ([1, -1], [1, 0]), 2: ([1, -2, 1], [2, 1, 0])}[order]
        right = sum(c * spline_at(x, y, x[1:-1] + k * h) for c, k in zip(*stencil)) / h ** order
        left = sum(c * spline_at(x, y, x[1:-1] - k * h) for c, k in zip(*stencil)) * (-1) ** order / h ** order
        assert np.allclose(left, right, atol=0.05)


def test_spline_in_chunks_equals_the_whole(series, column, monkeypatch):
    r = np.random.default_rng(4)
    given = [X if r.random() < 0.1 else float(v) for v in np.round(np.cumsum(r.normal(size=700)), 3)]
    given[300:340] = [X] * 40
    given[0] = X
    given[-1] = X
    known = [i for i, v in enumerate(given) if v is not X]
    whole = spline_at(np.array(known, float), np.array([given[i] for i in known]), np.arange(700.0))
    want = list(given)
    i = 0
    while i < 700:
        j = i
        while j < 700 and given[j] is X:
            j += 1
        if 0 < j - i <= 4:
            want[i:j] = whole[i:j]
        i = max(j, i + 1)
    monkeypatch.setattr(signal, "KNOTS", 128)
    got = column(sw.interpolate_gaps(series(given), sw.Layout(slots=64), method="spline"), "mean_filled")
    assert [v is X for v in got] == [v is X for v in want]
    assert np.allclose([v for v in got if v is not X], [v for v in want if v is not X], rtol=0, atol=1e-9)


@pytest.mark.parametrize("knots", [0, 1, 2, 3, 4, 5, 6])
def test_spline_of_few_values(series, column, knots):
    """Gaps between, before and behind the values; the curve is the direct solution's."""
    known = {1 + 3 * k + k % 2: float((k * 7) % 5) for k in range(knots)}
    n = max(known, default=2) + 2
    given = [known.get(i, X) for i in range(n)]
    got = column(sw.interpolate_gaps(series(given), method="spline"), "mean_filled")
    if not known:
        assert got == [X] * n
        return
    whole = spline_at(np.array(list(known), float), np.array(list(known.values())), np.arange(float(n)))
    assert got == pytest.approx(list(whole), abs=1e-12)


def test_spline_stays_in_the_jvm(series):
    plan = sw.interpolate_gaps(series([1.0, X, 3.0]), method="spline")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_low_pass_impulse(series, column):
    impulse = [0.0] * 10 + [1.0] + [0.0] * 10
    once = column(sw.low_pass(series(impulse), passes=1), "smoothed_mean")
    assert once[:2] == [X, X] and once[8:13] == [1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16]
    thrice = column(sw.low_pass(series(impulse)), "smoothed_mean")
    assert thrice[:6] == [X] * 6 and thrice[15:] == [X] * 6
    assert [v * 4096 for v in thrice[6:15]] == [66, 220, 495, 792, 924, 792, 495, 220, 66]
    kept = sw.low_pass(series(impulse, smoothed_mean=[7.0] + [X] * 20, types={"smoothed_mean": "double"}))
    assert column(kept, "smoothed_mean")[0] == 7.0
    holed = column(sw.low_pass(series(impulse[:8] + [X] + impulse[9:]), passes=1), "smoothed_mean")
    assert holed[6:11] == [X] * 5


@pytest.mark.parametrize("shape", ["spread", "tied", "tiny"])
def test_exact_quantiles(spark, shape):
    n = {"spread": 30000, "tied": 30000, "tiny": 7}[shape]
    r = np.random.default_rng(8)
    values = np.round(r.lognormal(size=n), 4) if shape != "tied" else np.where(r.random(n) < 0.6, 3.0, np.round(r.normal(size=n), 2))
    df = spark.createDataFrame([("k" if i % 3 else "l", float(v)) for i, v in enumerate(values)], "k string, v double")
    df = df.unionByName(spark.createDataFrame([("k", None), ("none", None)], "k string, v double")).repartition(8)
    v = F.col("v")
    got = {r["k"]: r for r in sw.exact_quantiles(df, ("k",), {
        "a": (v, 0.01), "b": (v, 0.99), "c": (v, 0.5), "d": (F.when(v < 0, v), 0.01)}).collect()}
    for key, part in (("k", values[np.arange(n) % 3 != 0]), ("l", values[np.arange(n) % 3 == 0])):
        for name, p in (("a", 0.01), ("b", 0.99), ("c", 0.5)):
            assert got[key][name] == pytest.approx(np.quantile(part, p), abs=1e-12), (key, name)
        below = part[part < 0]
        assert (got[key]["d"] is None) if not len(below) else got[key]["d"] == pytest.approx(np.quantile(below, 0.01), abs=1e-12)


def test_exact_quantiles_of_every_size(spark):
    r = np.random.default_rng(3)
    groups = {n: np.round(r.normal(size=n), 2 if n % 2 else 9) for n in [*range(1, 40), 499, 500, 501, 1999, 2000, 2001, 12_000]}
    df = spark.createDataFrame([(n, float(v)) for n, values in groups.items() for v in values], "k int, v double").repartition(4)
    quantiles = {f"q{i}": p for i, p in enumerate((0.0, 0.01, 0.5, 0.99, 1.0))}
    got = {row["k"]: row for row in sw.exact_quantiles(df, ("k",), {q: (F.col("v"), p) for q, p in quantiles.items()}).collect()}
    for n, values in groups.items():
        assert [got[n][q] for q in quantiles] == pytest.approx(list(np.quantile(values, list(quantiles.values()))), abs=1e-12), n


@pytest.mark.parametrize("shape", ["equal", "distinct"])
def test_one_task_never_orders_a_group(spark, shape):
    """Two million rows of one group: what a window orders is a few thousand rows at most."""
    n = 2_000_000
    df = spark.range(n).select(F.lit("k").alias("k"), (F.lit(7.0) if shape == "equal" else F.pmod(F.col("id") * 7919, F.lit(n)) * 1.0).alias("v"))
    out = sw.exact_quantiles(df, ("k",), {"a": (F.col("v"), 0.01), "b": (F.col("v"), 0.99)})
    got = out.collect()[0]
    want = (7.0, 7.0) if shape == "equal" else (0.01 * (n - 1), 0.99 * (n - 1))
    assert (got["a"], got["b"]) == pytest.approx(want, rel=1e-12)


def test_trimmed_deviation_like_the_plain_one(spark):
    """Sums behind the brackets, values inside them, brackets that overlap, and groups that vanish."""
    r = np.random.default_rng(4)
    groups = {f"s{n}": np.round(r.normal(1e6, 3, n), 2 if n % 2 else 7) for n in (1, 2, 3, 4, 60, 61, 900, 40_000, 40_001)}
    groups["same"] = np.full(500, 3.25)
    data = [(s, at(i), float(v)) for s, values in groups.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "site string, dt_round timestamp, mean double").selectExpr(
        "site", "'DO' AS parameter", "'monsoon' AS season", "dt_round", "mean", "CAST(NULL AS DOUBLE) AS slope_behind").repartition(6)
    got = {r["site"]: r for r in sw.threshold_table(df).collect()}
    for s, values in groups.items():
        lo, hi = np.quantile(values, [0.01, 0.99])
        inner = values[(values > lo) & (values < hi)]
        if not len(inner):
            assert s not in got
            continue
        assert (got[s]["t_mean01"], got[s]["t_mean99"]) == (pytest.approx(lo, rel=1e-13), pytest.approx(hi, rel=1e-13))
        assert got[s]["t_sd_0199"] == (pytest.approx(np.std(inner, ddof=1), rel=1e-7) if len(inner) > 1 else None)
        assert got[s]["t_slope_behind_01"] is None


def test_threshold_table(spark, series):
    r = np.random.default_rng(0)
    means = [float(v) for v in np.round(r.normal(10, 2, 500), 3)]
    df = sw.summary_statistics(series(means))
    row = sw.threshold_table(df).first()
    lo, hi = np.quantile(means, [0.01, 0.99])
    inner = [v for v in means if lo < v < hi]
    slopes = np.diff(means) / 15
    assert row["t_mean01"] == pytest.approx(lo) and row["t_mean99"] == pytest.approx(hi)
    assert row["t_sd_0199"] == pytest.approx(np.std(inner, ddof=1))
    assert row["t_slope_behind_99"] == pytest.approx(np.quantile(slopes[slopes > 0], 0.99))
    assert row["t_slope_behind_01"] == pytest.approx(np.quantile(slopes[slopes < 0], 0.01))
    near = sw.threshold_table(df, approx=True).first()
    assert abs(near["t_mean99"] - hi) < 0.5
    assert sw.threshold_table(sw.summary_statistics(series([1.0]))).count() == 0
