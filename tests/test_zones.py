import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.operators import publish as P
from verdance.operators import zonal as Z
from verdance.plans import pipeline, products

GRID = (10.0, 0.0, 0.0, 0.0, -10.0, 200.0)
SHAPES = {
    "a": '{"type":"Polygon","coordinates":[[[5,195],[95,195],[95,105],[5,105],[5,195]]]}',
    "b": '{"type":"MultiPolygon","coordinates":[[[[110,190],[190,190],[150,110],[110,190]]],[[[10,90],[60,90],[60,40],[10,40],[10,90]],[[20,80],[40,80],[40,60],[20,60],[20,80]]]]}',
    "far": '{"type":"Polygon","coordinates":[[[1005,195],[1095,195],[1095,105],[1005,195]]]}',
}


@pytest.fixture(scope="module")
def zones(spark):
    rows = [(k, v) for k, v in SHAPES.items()] + [("none", None), ("line", '{"type":"LineString","coordinates":[[0,0],[1,1]]}'), ("bad", "{oops")]
    return spark.createDataFrame(rows, "id_parcela string, g string").withColumn("parts", G.parse_geojson(F.col("g")))


@pytest.fixture(scope="module")
def pixels(spark):
    v = np.random.default_rng(1).uniform(-0.2, 1.0, (20, 20))
    return spark.createDataFrame([(r, c, None if (r * 7 + c) % 11 == 0 else float(v[r, c])) for r in range(20) for c in range(20)], "row int, col int, value double")


def test_areas(spark, zones):
    got = {r.id_parcela: r.a for r in zones.select("id_parcela", G.shape_area(F.col("parts")).alias("a")).collect()}
    assert got["a"] == 8100 and got["b"] == 3200 + 2500 - 400 and got["none"] is None and got["line"] is None and got["bad"] is None
    wkt = "geography'SRID=4326;MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((10 10, 12 10, 12 12, 10 12, 10 10)))'"
    rows = spark.createDataFrame([(wkt,), ("POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))",), (SHAPES["a"],), ("POINT(1 1)",), (None,)], "f string")
    assert [r[0] for r in rows.select(G.shape_area(G.parse_footprint(F.col("f")))).collect()] == [19.0, 4.0, 8100.0, None, None]


def test_touch_conserves_area(zones, pixels):
    got = {r.id_parcela: r.a for r in Z.touch_join(pixels, zones, GRID, tile=35.0).groupBy("id_parcela").agg(F.sum("overlap").alias("a")).collect()}
    assert abs(got["a"] - 8100) < 1e-6 and abs(got["b"] - 5300) < 1e-6 and set(got) == {"a", "b"}


def test_centres_and_burning(zones, pixels):
    a = {(r.row, r.col) for r in Z.centre_join(pixels, zones, GRID, tile=35.0).where("id_parcela = 'a'").collect()}
    # centres on the left and top edge are in, those on the right and bottom aren't, or the other way; never both
    assert {(r, c) for r in range(1, 9) for c in range(1, 9)} <= a and len(a) == 81
    burnt = Z.burn(pixels, zones.withColumn("v", F.when(F.col("id_parcela") == "a", 1.0).otherwise(2.0)), GRID, "v", tile=35.0)
    assert burnt.count() == 400 and burnt.where("v = 1").count() == 100


def test_union_area():
    box = lambda x, y, w, h: [[(x, y), (x + w, y), (x + w, y + h), (x, y + h)]]
    assert abs(G.union_area([box(0, 0, 2, 2), box(1, 1, 2, 2)]) - 7) < 1e-9
    assert abs(G.union_area([box(0, 0, 2, 2), box(1, 1, 2, 2)], box(0, 0, 2, 4)) - 5) < 1e-9
    assert abs(G.union_area([[[(0, 0), (4, 0), (0, 4)]], [[(4, 4), (0, 4), (4, 0)]]]) - 16) < 1e-9
    assert G.union_area([]) == 0


def redfearn(lon, lat, centre):
    """Transverse Mercator by another series: powers of the longitude difference."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    p, e4, e6 = np.radians(lat), e2**2, e2**3
    ep, n, t, c = e2 / (1 - e2), a / np.sqrt(1 - e2 * np.sin(p) ** 2), np.tan(p) ** 2, e2 / (1 - e2) * np.cos(p) ** 2
    w = np.cos(p) * np.radians(lon - centre)
    m = a * ((1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * p - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * np.sin(2 * p) + (15 * e4 / 256 + 45 * e6 / 1024) * np.sin(4 * p) - 35 * e6 / 3072 * np.sin(6 * p))
    east = k0 * n * (w + (1 - t + c) * w**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep) * w**5 / 120) + 500_000
    return east, k0 * (m + n * np.tan(p) * (w**2 / 2 + (5 - t + 9 * c + 4 * c**2) * w**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * ep) * w**6 / 720))


def test_utm_against_another_series(spark):
    rows = [(lon, lat) for lon in (-95.9, -93.0, -91.2, -90.1) for lat in (0.0, 12.5, 14.0, 23.0)]
    e, n = G.utm_forward(F.col("lon"), F.col("lat"), 32615)
    for r in spark.createDataFrame(rows, "lon double, lat double").select("lon", "lat", e.alias("e"), n.alias("n")).collect():
        want = redfearn(r.lon, r.lat, -93)
        assert abs(r.e - want[0]) < 0.02 and abs(r.n - want[1]) < 0.02


@pytest.fixture(scope="module")
def parcels(zones):
    start = F.when(F.col("id_parcela") == "a", F.lit("2024-12-20")).otherwise(F.lit("2024-06-01")).cast("date")
    return zones.where("parts is not null").select("id_parcela", F.lit("2026").alias("zafra"), start.alias("fecha_inicio"), F.lit("Mill").alias("ingenio"), F.lit("Co").alias("company"), F.lit("1").alias("ingenio_id"), F.lit("2").alias("company_id"), "parts")


DAY = dt.date(2025, 1, 10)


def test_index_product(pixels, parcels):
    out = products.index_product(pixels, parcels, GRID, F.lit(DAY), "NDVI", None, F.lit("GT"), tile=35.0, extras=True)
    rows = {r.id_parcela: r for r in out.collect()}
    assert set(rows) == {"a", "b", "far"} and rows["far"].ndvi_mean is None and rows["far"].ndvi_1 is None
    for k in ("a", "b"):
        r = rows[k]
        total = sum(r[f"ndvi_{i}"] for i in range(1, 15))
        assert 0 < total <= {"a": 0.81, "b": 0.53}[k] + 1e-9 and abs(r.cosechado + r.cultivo_en_pie - total) < 1e-9
        assert sum(r[f"ndvi_pot_{i}"] for i in range(1, 6)) >= total - 1e-9
        assert r.ndvi_min <= r.ndvi_median <= r.ndvi_max
    assert rows["a"].edad == 21 and rows["a"].potencial is not None
    assert P.audit(out, "NDVI").first().missing_columns == []


def test_growth_product(spark, pixels, parcels):
    k = pixels.select("row", "col", (F.pmod(F.hash("row", "col"), F.lit(5)) + 1).cast("double").alias("value"))
    out = {r.id_parcela: r for r in products.growth_product(k, k, parcels, GRID, F.lit(DAY), 35.0).collect()}
    assert 20 <= out["a"].sg_min <= out["a"].sg_max <= 100 and out["far"].sg_mean is None
    none = products.growth_product(k.limit(0), k, parcels, GRID, F.lit(DAY), 35.0).collect()
    assert all(r.sg_mean == 0 for r in none)


def test_weed_product(pixels, parcels):
    out, weeds = products.weed_product(pixels, parcels, GRID, F.lit(DAY), tile=35.0)
    rows = out.collect()
    assert [r.id_parcela for r in rows] == ["a"] and rows[0].status_maleza in ("Critica", "Evaluar") and 0 <= rows[0].percent_maleza <= 100
    assert abs(rows[0].area_maleza - sum(r.area_calculada for r in weeds.collect())) < 1e-12
    none, cells = products.weed_product(pixels, parcels.where("id_parcela = 'b'"), GRID, F.lit(DAY), tile=35.0)
    assert none.count() == 0 and cells.count() == 0 and set(none.columns) == set(out.columns)
    low, _ = products.weed_product(pixels.withColumn("value", F.lit(-0.5)), parcels, GRID, F.lit(DAY), tile=35.0)
    assert low.first().status_maleza == "Sin Maleza" and low.first().percent_maleza == 0


def test_history_and_potential(spark, pixels, parcels):
    _, weeds = products.weed_product(pixels, parcels, GRID, F.lit(DAY), tile=35.0)
    weeds = weeds.select("id_parcela", "row", "col", "fecha_deteccion").cache()
    rows, counts = products.weed_temporality(weeds.limit(0), weeds, ["id_parcela"])
    assert rows.count() == weeds.count() == counts.count() and counts.agg(F.max("overlap_count")).first()[0] == 1
    again, _ = products.weed_temporality(rows, weeds, ["id_parcela"])
    assert again.count() == rows.count()
    now = rows
    for i in range(1, 8):
        now, counts = products.weed_temporality(now, weeds.withColumn("fecha_deteccion", F.lit(dt.date(2025, 1, 10) + dt.timedelta(days=i))), ["id_parcela"])
    assert now.select("fecha_deteccion").distinct().count() == 5 and counts.agg(F.max("overlap_count")).first()[0] == 5
    k = products.potential_classes(pixels, parcels.withColumn("potencial", F.lit(0.5)), GRID, 35.0)
    assert {r.value for r in k.select("value").distinct().collect()} <= {None, 1, 2, 3, 4, 5}


def test_pipeline_isolates_errors(spark):
    def make(date, product):
        if product == "NDWI":
            raise ValueError("no raster")
        return spark.range(1)

    out = pipeline.run(["d1", "d2"], None, make)
    assert len(out.tables) == 6 and set(out.errors) == {("d1", "NDWI"), ("d2", "NDWI")}


def test_hectares_in_metres(spark):
    side = 0.01
    shape = '{"type":"Polygon","coordinates":[[[-91.0,14.0],[-90.99,14.0],[-90.99,14.01],[-91.0,14.01],[-91.0,14.0]]]}'
    got = spark.range(1).select(G.hectares(G.parse_geojson(F.lit(shape)), 32615)).first()[0]
    # a hundredth of a degree each way, on the ellipsoid, with the map's scale squared
    lat = np.radians(14.005)
    e2 = (1 / 298.257223563) * (2 - 1 / 298.257223563)
    m = 6378137 * (1 - e2) / (1 - e2 * np.sin(lat) ** 2) ** 1.5
    n = 6378137 / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    true = np.radians(side) ** 2 * m * n * np.cos(lat) / 10_000
    assert abs(got / true - 1) < 2e-3
