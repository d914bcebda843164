import numpy as np
import pytest
from pyspark.sql import functions as F

from verdance.functions import tables as K
from verdance.operators import cloud
from verdance.operators import raster as R


def cells(spark, a, name="value"):
    rows = [(int(r), int(c), None if np.isnan(a[r, c]) else float(a[r, c])) for r in range(a.shape[0]) for c in range(a.shape[1])]
    return spark.createDataFrame(rows, f"row int, col int, {name} double")


def array(df, shape, name="value"):
    out = np.full(shape, np.nan)
    for r in df.select("row", "col", F.col(name).alias("v")).collect():
        if 0 <= r.row < shape[0] and 0 <= r.col < shape[1] and r.v is not None:
            out[r.row, r.col] = r.v
    return out


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_focal_is_the_mirrored_box(spark, radius):
    a = np.random.default_rng(1).normal(size=(9, 12))
    got = R.focal(cells(spark, a), radius)
    pad = np.pad(a, radius, mode="symmetric")
    win = np.lib.stride_tricks.sliding_window_view(pad, (2 * radius + 1,) * 2)
    assert np.allclose(array(got, a.shape, "mean"), win.mean(axis=(2, 3))) and np.allclose(array(got, a.shape, "variance"), win.var(axis=(2, 3)))


def test_dilation_is_a_diamond(spark):
    a = (np.random.default_rng(2).random((20, 20)) < 0.02).astype(float)
    got = array(R.cloud_mask(cells(spark, np.where(a, 9.0, 4.0), "SCL"), 5).withColumn("b", F.col("buffered").cast("double")), a.shape, "b")
    want = a.astype(bool)
    for _ in range(5):
        p = np.pad(want, 1)
        want = p[1:-1, 1:-1] | p[:-2, 1:-1] | p[2:, 1:-1] | p[1:-1, :-2] | p[1:-1, 2:]
    assert (got.astype(bool) == want).all()


def test_temporal_fill_is_weighted_least_squares(spark):
    rng, rows, want = np.random.default_rng(3), [], {}
    for k in range(40):
        n = k % 6
        days, v, cloudy = rng.integers(1, 60, n), rng.normal(1000, 800, n), rng.random(n) < 0.3
        if k == 11 and n:
            days[:] = 7
        rows += [(0, k, int(d), bool(c), float(x)) for d, c, x in zip(days, cloudy, v)]
        d, y = days[~cloudy].astype(float), v[~cloudy]
        w = 1 / np.maximum(d, 1)
        if len(d) == 1:
            want[k] = y[0]
        elif len(d) > 1:
            den = w.sum() * (w * d * d).sum() - (w * d).sum() ** 2
            slope = np.clip((w.sum() * (w * d * y).sum() - (w * d).sum() * (w * y).sum()) / den, -500, 500) if abs(den) > 1e-10 else None
            want[k] = max(0, (w * y).sum() / w.sum() if slope is None else ((w * y).sum() - slope * (w * d).sum()) / w.sum())
    got = {r.col: r.B for r in R.temporal_fill(spark.createDataFrame(rows, "row int, col int, days int, cloud boolean, B double"), ["B"]).collect()}
    for k, v in got.items():
        assert (v is None) == (k not in want) and (v is None or abs(v - want[k]) < 1e-6)


def test_nearest_fill_and_calculator(spark):
    a = np.random.default_rng(4).normal(size=(12, 12))
    a[np.random.default_rng(5).random(a.shape) < 0.4] = np.nan
    got, want = array(R.nearest_fill(cells(spark, a), "value", 4), a.shape), a.copy()
    ok = np.argwhere(~np.isnan(a))
    for r, c in np.argwhere(np.isnan(a)):
        d = ((ok - (r, c)) ** 2).sum(axis=1)
        if d.min() <= 16:
            want[r, c] = a[tuple(ok[np.lexsort((ok[:, 1], ok[:, 0], d))[0]])]
    assert np.array_equal(got, want, equal_nan=True)
    b = np.where(np.arange(144).reshape(12, 12) % 5 == 0, 0.0, 2.0)
    assert np.allclose(array(R.calculate(cells(spark, a), cells(spark, b), "divide"), a.shape), np.where(np.isnan(a), np.nan, np.where(b == 0, 0, a / 2)), equal_nan=True)


def test_resample_on_the_same_grid_is_identity(spark):
    a = np.random.default_rng(6).normal(size=(5, 7))
    g = (10.0, 0.0, 500.0, 0.0, -10.0, 900.0)
    assert np.allclose(array(R.resample(cells(spark, a), g, cells(spark, a), g), a.shape), a)
    half = R.resample(cells(spark, a), g, cells(spark, a), (10.0, 0.0, 505.0, 0.0, -10.0, 900.0))
    assert np.allclose(array(half, a.shape)[:, :6], (a[:, :6] + a[:, 1:]) / 2)


def test_cloud_removal_keeps_clear_cells(spark):
    rng = np.random.default_rng(7)
    n, bands = 24, ["B04", "B08"]
    scl = np.where(rng.random((n, n)) < 0.15, 9, 4)
    rows = [(r, c, int(scl[r, c]), float(r * 10 + c), float(1000 + r)) for r in range(n) for c in range(n)]
    target = spark.createDataFrame(rows, "row int, col int, SCL int, B04 double, B08 double")
    previous = spark.createDataFrame([("a", d, r, c, 9 if c < 4 else 4, b + d, e - d) for d in (5, 10) for r, c, _, b, e in rows], "scene_date string, days int, row int, col int, SCL int, B04 double, B08 double")
    out = cloud.remove_clouds(target, previous, None, bands, buffer=1, radius=10)
    got = out.collect()
    by = {(r, c): (s, b, e) for r, c, s, b, e in rows}
    assert len(got) == n * n and all(x.B04 is not None for x in got)
    for x in got:
        s, b, e = by[x.row, x.col]
        if s == 4:
            assert (x.B04, x.B08, x.source) == (b, e, "clear")
        elif x.col >= 4:
            assert x.source == "temporal" and abs(x.B04 - b) < 1e-6 and abs(x.B08 - e) < 1e-6
        else:
            assert x.source == "spatial"
    check = cloud.clear_unchanged(target, out, "B04").first()
    assert check.changed == 0 and check.cells > 0
    conf = cloud.scene_confidence(out, 2).first()
    assert conf.cloud_pixels == int((scl == 9).sum()) == conf.temporal_filled + conf.spatial_filled and 0 <= conf.confidence_overall <= 100


def test_forest_learns_the_radar(spark):
    rng = np.random.default_rng(8)
    n = 30
    vv, vh = rng.uniform(0.1, 1, (n, n)), rng.uniform(0.1, 1, (n, n))
    band = 1000 * vv + 300 * vh
    rad = spark.createDataFrame([(s, r, c, float(vv[r, c]), float(vh[r, c])) for s in ("p", None) for r in range(n) for c in range(n)], "scene_date string, row int, col int, VV double, VH double")
    target = spark.createDataFrame([(r, c, 9 if (r + c) % 3 == 0 else 4, float(band[r, c])) for r in range(n) for c in range(n)], "row int, col int, SCL int, B04 double")
    # no clear scene where the target is cloudy: only the radar can tell
    previous = spark.createDataFrame([("p", 5, r, c, 9 if (r + c) % 3 == 0 else 4, float(band[r, c])) for r in range(n) for c in range(n)], "scene_date string, days int, row int, col int, SCL int, B04 double")
    got = cloud.remove_clouds(target, previous, rad, ["B04"], trees=20, depth=8).where("source = 'fusion'").collect()
    errors = [abs(x.B04 - band[x.row, x.col]) for x in got]
    assert len(got) == sum((r + c) % 3 == 0 for r in range(n) for c in range(n)) and np.mean(errors) < 0.5 * np.abs(band - band.mean()).mean()


def test_band_names():
    assert cloud.band_names(15) == (K.OPTICAL_BANDS, 14)
    assert cloud.band_names(5)[0][-1] == "SCL" and cloud.band_names(2, ["x", "y"])[1] == 1
    assert cloud.band_names(3, ["band B04", "B8A 20m", "scl"]) == (["B04", "B8A", "SCL"], 2)
