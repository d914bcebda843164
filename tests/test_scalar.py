import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdance.functions import scalar as S
from verdance.functions import tables as K


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_age_and_stage(spark):
    day = dt.date(2025, 1, 1)
    ages = [0, 60, 61, 90, 91, 120, 121, 210, 211, 300, 301, 450, 451, 900, -5]
    rows = [(a, day - dt.timedelta(days=a)) for a in ages] + [(None, None)]
    got = values(spark, rows, "a int, s date", S.age_days(F.lit(day), F.col("s")), S.growth_stage(F.col("a")))
    assert [g[0] for g in got] == [min(a, 450) for a in ages] + [None]
    assert [g[1] for g in got][:12] == ["Iniciacion"] * 2 + ["Macollamiento"] * 4 + ["Elongacion I"] * 2 + ["Elongacion II"] * 2 + ["Maduracion"] * 2
    assert got[-1][1] == "SF"


@pytest.mark.parametrize("kind", ["float", "double"])
def test_reclassify_bounds(spark, kind):
    bounds = sorted({x for r in K.NDVI_CLASSES for x in r[:2]})
    x = bounds + [b - 1e-3 for b in bounds] + [-2.0, 5.0]
    got = [g[0] for g in values(spark, [(v,) for v in x], f"v {kind}", S.reclassify(F.col("v"), K.NDVI_CLASSES, kind))]
    cast = np.float32 if kind == "float" else np.float64
    for v, g in zip(x, got):
        want = [k for lo, hi, k in K.NDVI_CLASSES if cast(lo) <= cast(v) < cast(hi)]
        assert g == (want[-1] if want else None)


@pytest.mark.parametrize("past, new, verdict", [("3", None, "ok_empty"), ("3", "x", "invalid_not_numeric"), (None, "9", "ok_no_past"), ("x", "9", "ok_no_past"), ("3", "4.0", "ok_next"), ("3.9", "4", "ok_next"), ("3", "0", "ok_restart"), ("3", "3", "invalid_jump"), ("3", "inf", "invalid_not_numeric")])
def test_cycle_rules(spark, past, new, verdict):
    assert values(spark, [(past, new)], "p string, n string", S.cycle_check(F.col("p"), F.col("n")))[0][0] == verdict


def test_cells_of_sheets(spark):
    cells = [*K.NULL_TOKENS, " 7 ", "12.0", "abc", "inf", "TRUE", "no", "2024-1-5", "20240105", "2024_01_05", "2024-01-05 10:00:00", "2024-13-05", "5/1"]
    got = values(spark, [(c,) for c in cells], "c string", S.cleaned(F.col("c")), S.coerce_number(F.col("c")), S.coerce_boolean(F.col("c")), S.parse_date(F.col("c")), S.is_infinite(F.col("c")))
    by = dict(zip(cells, got))
    assert all(by[t] == (None, None, None, None, False) for t in K.NULL_TOKENS)
    assert by[" 7 "][:2] == ("7", 7.0) and by["12.0"][1] == 12.0 and by["abc"][1] is None and by["inf"][1:] == (None, False, None, True)
    assert by["TRUE"][2] is True and by["no"][2] is False
    assert {by[c][3] for c in ("2024-1-5", "20240105", "2024_01_05", "2024-01-05 10:00:00")} == {dt.date(2024, 1, 5)}
    assert by["2024-13-05"][3] is None and by["5/1"][3] is None


def test_rounding_and_division(spark):
    got = values(spark, [(0.125, 1.0, 0.0), (None, 1.0, 2.0)], "x double, a double, b double", S.round_half_even(F.col("x")), S.safe_divide(F.col("a"), F.col("b")), S.raster_math(F.col("x"), F.col("b"), "add"))
    assert got == [(0.12, 0.0, 0.125), (None, 0.5, None)]


def test_names(spark):
    rows = [("S2A_MSIL2A_20240301T161829_N0509_R140_T15PYS_20240301T2.SAFE", "dir/prev03_2024-02-11/x.tif"), ("other", "dir/inference_20240211/x.tif")]
    role, date = S.folder_role(F.col("f"))
    got = values(spark, rows, "p string, f string", S.scene_date(F.col("p")), S.tile_of(F.col("p")), role, date)
    assert got == [(dt.date(2024, 3, 1), "15PYS", "prev03", dt.date(2024, 2, 11)), (None, None, "inference", dt.date(2024, 2, 11))]
    name = S.file_name(F.lit("GT"), F.lit("CO"), F.lit("NDVI"), F.lit("Mill_A"), F.lit("2024-03-01").cast("date"))
    assert values(spark, [(1,)], "x int", name, S.published_table(name), S.published_table(F.lit("x_WEED.parquet"))) == [("GT_CO_DATA_NDVI_Mill_A_2024_03_01.parquet", "data_ndvi", "data_maleza")]


def test_potential_is_the_polynomial(spark):
    for (region, index), c in K.POTENTIAL.items():
        got = values(spark, [(a,) for a in (0, 90, 450)], "a int", S.potential(F.lit(region), index, F.col("a")))
        assert np.allclose([g[0] for g in got], np.polyval(c, [0, 90, 450]), rtol=1e-12)


def test_confidence_levels(spark):
    def of(*x):
        c = S.confidence(*[F.lit(v) for v in x])
        return values(spark, [(1,)], "x int", c["confidence_overall"], c["confidence_level"])[0]

    assert of(5, 0.0, 0.0, 0.0, 0, 0, 0) == (100.0, "HIGH")
    assert of(0, 100.0, 50.0, 10.0, 0, 0, 0) == (5.0, "MINIMAL")
    score, level = of(3, 50.0, 10.0, 100.0, 50, 30, 10)
    assert abs(score - (0.3 * 75 + 0.25 * max(5, 100 - 0.8 * 50**1.3) + 0.3 * 76.5 + 0.15 * 80)) < 1e-9 and level in ("LOW", "MEDIUM")


def test_catalogue_attributes(spark):
    rows = [([("x", "1"), ("CloudCover", "12.5"), ("cloudcover2", "9")],), ([],), (None,)]
    got = values(spark, rows, "a array<struct<Name:string,Value:string>>", S.first_cloud_cover(F.col("a")))
    assert [g[0] for g in got] == [12.5, None, None]
