import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdance.operators import curves as C
from verdance.operators import publish as P
from verdance.operators import scenes as N
from verdance.operators import sync as Y
from verdance.operators import temporal as T
from verdance.sources import config, geotiff, sinks, tables
from verdance.streaming import cloud_windows, stream_history

PARCEL = "id_parcela string, ingenio string, zafra string, temporada_activa boolean, ciclo double, area_real double, variedad string, fecha_inicio date, fecha_fin date"
TODAY = dt.date(2026, 6, 1)


@pytest.fixture
def parcel_table(spark):
    d = dt.date
    return spark.createDataFrame([("p1", "M", "2026", True, 2.0, 10.0, "X", d(2025, 5, 1), None), ("p2", "M", "2026", True, 0.0, 20.0, "Y", d(2025, 5, 1), None), ("p3", "M", "2027", True, 1.0, 5.0, "Z", d(2026, 1, 1), None), ("p3", "M", "2025", False, 0.0, 4.0, "W", d(2024, 1, 1), None)], PARCEL)


def sheet(spark, rows, columns):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join([*(f"`{c}` string" for c in columns), "__order int"]))


def test_sync(spark, parcel_table):
    closing = sheet(spark, [("p1", "M", "2026-05-01", "99.5"), ("p2", "M", "2026-12-01", "1"), ("nope", "M", "2026-01-01", "1"), ("p1", "M", "2026-05-02", "N/A"), ("p4", "M", "2026-01-01", "inf")], ["id_parcela", "ingenio", "fecha_fin", "area_real"])
    opening = sheet(spark, [("p1", "M", "2026-05-10", "3.0", "-"), ("p2", "M", "2026-05-10", "7", "Q"), ("p3", "M", "2026-05-11", "1", "ZZ"), ("new", "M", "2026-05-12", "", "N"), ("late", "M", "2026-07-12", "1", "N")], ["id_parcela", "ingenio", "fecha_inicio", "ciclo", "variedad"])
    out = Y.sync(parcel_table, closing, opening, F.lit(TODAY), "m")
    rows = {(r.id_parcela, r.zafra): r for r in out.table.collect()}
    # the last closing row wins; a cell without a value keeps the old one
    assert rows["p1", "2026"].temporada_activa is False and rows["p1", "2026"].fecha_fin == dt.date(2026, 5, 2) and rows["p1", "2026"].area_real == 10.0
    assert rows["p2", "2026"].temporada_activa is True
    new = rows["p1", "2027"]
    assert new.temporada_activa and new.ciclo == 3.0 and new.variedad == "X" and new.area_real == 10.0
    assert ("p2", "2027") not in rows and ("late", "2027") not in rows
    assert rows["p3", "2027"].variedad == "ZZ" and rows["p3", "2025"].variedad == "W"
    assert rows["new", "2027"].variedad == "N"
    log = {(r.id_parcela, r.action) for r in out.log.collect()}
    assert {("p1", "closed"), ("nope", "skipped"), ("p1", "inserted"), ("p2", "ciclo_error"), ("p3", "updated"), ("new", "inserted"), ("p4", "error")} <= log
    again = Y.sync(out.table, closing, opening, F.lit(TODAY), "m")
    assert sorted(map(str, again.table.collect())) == sorted(map(str, out.table.collect()))
    assert {r.action: r.n for r in Y.preview(closing, opening, F.lit(TODAY)).collect()} == {"close": 4, "open": 4}


def test_curves(spark):
    curve = spark.createDataFrame([(30, 3.0), (10, 1.0), (20, 5.0), (None, 9.0)], "x int, y double")
    ages = [None, 0, 10, 13, 20, 27, 30, 99]
    got = {r.a: r.v for r in C.interpolate(spark.createDataFrame([(a,) for a in ages], "a int"), curve, "a", "x", "y", "v").collect()}
    assert got[None] is None
    for a in ages[1:]:
        assert abs(got[a] - np.interp(a, [10, 20, 30], [1, 5, 3])) < 1e-12
    by = C.interpolate(spark.createDataFrame([("u", 15), ("v", 15), ("w", 15)], "m string, a int"), curve.withColumn("m", F.lit("u")).unionByName(curve.withColumn("m", F.lit("v")).withColumn("y", F.lit(0.5))), "a", "x", "y", "p", ["m"])
    assert {r.m: r.p for r in by.collect()} == {"u": 3.0, "v": 0.5, "w": None}


def test_nearest_date_ties_go_later(spark):
    day = lambda n: dt.date(2024, 1, n)
    left = spark.createDataFrame([(day(10),), (day(1),), (day(30),), (None,)], "a date")
    right = spark.createDataFrame([(day(8),), (day(12),), (day(20),)], "b date")
    got = {r.a: (r.nearest, r.diff_days) for r in T.nearest_date(left, right, "a", "b").collect()}
    assert got == {day(10): (day(12), 2), day(1): (day(8), 7), day(30): (day(20), 10), None: (None, None)}


def test_scene_choice(spark):
    d = lambda n: dt.date(2024, 3, n)
    days = lambda rows: spark.createDataFrame(rows, "date date, coverage_pct double").withColumn("is_complete", F.col("coverage_pct") >= 95)
    pick = lambda rows: tuple(N.inference_date(days(rows), F.lit(d(10)), F.lit(d(15))).first())
    assert pick([(d(11), 99.0), (d(14), 96.0), (d(20), 100.0)]) == (d(14), False)
    assert pick([(d(11), 50.0), (d(12), 60.0), (d(13), 60.0), (d(2), 99.0)]) == (d(12), True)
    assert pick([(d(2), 99.0), (d(3), 97.0), (d(12), 0.0)]) == (d(3), False)
    assert pick([(d(2), 9.0)]) == (None, False)
    products = spark.createDataFrame([(d(11), "T1", "b", "2", "POLYGON((0 0, 5 0, 5 10, 0 10, 0 0))", 10.0), (d(11), "T2", "c", "3", "POLYGON((4 0, 10 0, 10 10, 4 10, 4 0))", None), (d(12), "T1", "d", "4", "POLYGON((50 0, 55 0, 55 5, 50 0))", 1.0)], "date date, tile_id string, product_name string, product_id string, footprint string, cloud_cover double")
    from verdance.functions import geometry as G

    aoi = spark.range(1).select(G.parse_wkt(F.lit("POLYGON((1 1, 9 1, 9 9, 1 9, 1 1))")).alias("parts"))
    r = N.date_coverage(products, aoi).collect()
    assert len(r) == 1 and r[0].date == d(11) and abs(r[0].coverage_pct - 100) < 1e-9 and r[0].cloud_cover == 10.0 and r[0].is_complete


def test_pairs_and_files(spark):
    files = spark.createDataFrame([("p/a_small.tif", 10, 1, "x"), ("p/a_big.tif", 9000, 1, "x"), ("p/s2_filled.tif", 10, 1, "y"), ("p/z.tif", 99_999, 1, "y")], "path string, length long, modificationTime int, g string")
    assert {r.g: r.path for r in N.pick_file(files, ["g"], ["s2_filled.tif"]).collect()} == {"x": "p/a_big.tif", "y": "p/s2_filled.tif"}
    none = spark.createDataFrame([], "s2_exists boolean, s1_exists boolean")
    assert tuple(N.pair_summary(none).first()) == (0, 0, 100.0)
    w = spark.range(1).select(T.inference_window(F.lit(dt.date(2024, 1, 30)), F.lit(dt.date(2024, 1, 30)))).first()[0]
    assert len(w) == 5 and w[-1] == dt.date(2024, 2, 3)


def test_publishing(spark):
    rows = spark.createDataFrame([("1.0", "2026", 1.5), ("1.5", "2026", 2.0), ("nan", "nan", 3.0), (None, None, None)], "company_id string, zafra string, x double")
    good, bad = P.published_types(rows, "data_sg")
    assert bad.count() == 1 and good.where("company_id = 1").first().zafra == "2026" and good.where("x = 3").first().zafra is None
    assert P.complete_rows(rows).count() == 3
    assert json.loads(P.records(rows.where("x is null")).first()[0]) == {"company_id": None, "zafra": None, "x": None}
    assert sorted(r[0] for r in P.missing_starts(spark.createDataFrame([("b", None), ("a", None), ("c", dt.date(2024, 1, 1))], "id_parcela string, fecha_inicio date")).collect()) == ["a", "b"]


def test_geotiff_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    for dtype in (np.float32, np.int16, np.uint8):
        for packed in (True, False):
            r = geotiff.Raster((rng.random((2, 5, 7)) * 100).astype(dtype), (10.0, 0.0, 5e5, 0.0, -10.0, 1.5e6), 32615, 7.0)
            d = geotiff.decode(geotiff.encode(r, packed))
            assert (d.data == r.data).all() and d.grid == r.grid and d.crs == 32615 and d.nodata == 7.0
    data = np.array([[[1.0, -32768.0], [np.nan, 4.0]]], np.float32)
    (tmp_path / "ndre_PROD_2024-03-01.tif").write_bytes(geotiff.encode(geotiff.Raster(data, (10.0, 0.0, 0.0, 0.0, -10.0, 0.0), 4326, -32768.0)))
    (tmp_path / "broken.tif").write_bytes(b"nothing")
    got = {(r.row, r.col): r.v for r in geotiff.read_pixels(spark, f"{tmp_path}/ndre*.tif", ["v"]).collect()}
    assert got == {(0, 0): 1.0, (0, 1): None, (1, 0): None, (1, 1): 4.0}
    heads = {r.raster_id.rsplit("/", 1)[1]: r for r in geotiff.read_grids(spark, str(tmp_path)).collect()}
    assert heads["ndre_PROD_2024-03-01.tif"].width == 2 and heads["ndre_PROD_2024-03-01.tif"].crs == 4326 and heads["broken.tif"].width is None
    content = geotiff.encode_pixels(geotiff.read_pixels(spark, f"{tmp_path}/ndre*.tif", ["v"]), (10.0, 0.0, 0.0, 0.0, -10.0, 0.0), 4326, ["v"]).first().content
    assert np.array_equal(geotiff.decode(bytes(content)).data[0], [[1, -32768], [-32768, 4]])


def test_lzw():
    # the strip of a small LZW image: clear, 10, 10 10, 20, end
    bits = "".join(f"{c:09b}" for c in (256, 10, 258, 20, 257))
    raw = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert geotiff.lzw(raw) == bytes([10, 10, 10, 20])


def test_scans_and_sinks(spark, tmp_path):
    (tmp_path / "s26.csv").write_text(" ID_Parcela ,Ingenio\np1,M\n")
    sheets = tables.read_sheets(spark, {2026: f"{tmp_path}/s26.csv", 2027: f"{tmp_path}/none.csv"})
    assert sheets[2026].first().id_parcela == "p1" and sheets[2026].first().zafra == "2026" and sheets[2027].count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_sheets(spark, {2026: f"{tmp_path}/no.csv"})
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id_parcela": "x"}, "geometry": shape}]}))
    r = tables.read_geojson(spark, f"{tmp_path}/p.geojson", "2026").first()
    assert r.id_parcela == "x" and r.zafra == "2026" and len(r.parts[0][0]) == 4
    answer = {"value": [{"Id": "i", "Name": "S2A_MSIL2A_20240301T161829_N0509_R140_T15PYS_x.SAFE", "Footprint": "POLYGON((0 0, 1 0, 1 1, 0 0))", "ContentDate": {"Start": "2024-03-01T16:00:00Z"}, "Attributes": [{"Name": "cloudCover", "Value": "3.5"}]}]}
    (tmp_path / "cat.json").write_text(json.dumps(answer))
    c = tables.read_catalogue(spark, f"{tmp_path}/cat.json").first()
    assert (c.date, c.tile_id, c.cloud_cover) == (dt.date(2024, 3, 1), "15PYS", 3.5)
    assert tables.read_curve(spark, f"{tmp_path}/no.parquet") is None
    rows = spark.createDataFrame([("a", dt.date(2024, 1, 1), "M", 1), ("b", dt.date(2024, 1, 2), "M", 2)], "id_parcela string, fecha_img date, ingenio string, v int")
    out = f"{tmp_path}/out"
    sinks.write_product(rows, out, "NDVI")
    sinks.write_product(rows.where("v = 2").withColumn("v", F.lit(9)), out, "NDVI")
    assert {r.id_parcela: r.v for r in spark.read.parquet(out).collect()} == {"a": 1, "b": 9}
    assert not sinks.write_log(rows.limit(0), f"{tmp_path}/log") and sinks.write_log(rows, f"{tmp_path}/log")
    parcels = spark.createDataFrame([("p", "M", True, json.dumps(shape)), ("q", "M", False, json.dumps(shape)), ("r", "M", True, None)], "id_parcela string, ingenio string, temporada_activa boolean, geometry_polygon string")
    parcels.write.parquet(f"{tmp_path}/parcels.parquet")
    got = tables.read_parcels(spark, f"{tmp_path}/parcels.parquet", "M")
    assert [r.id_parcela for r in got.collect()] == ["p"]
    assert "PushedFilters: [IsNotNull(ingenio)" in got._jdf.queryExecution().executedPlan().toString()


def test_curves_that_are_broken_are_errors(spark, tmp_path):
    (tmp_path / "c.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        tables.read_curve(spark, f"{tmp_path}/c.parquet").count()


def test_parcels_strictly(spark, tmp_path):
    shape = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]})
    spark.createDataFrame([("p", "M", True, shape), ("p", "M", True, shape)], "id_parcela string, ingenio string, temporada_activa boolean, geometry_polygon string").write.parquet(f"{tmp_path}/p.parquet")
    with pytest.raises(LookupError):
        tables.read_parcels(spark, f"{tmp_path}/p.parquet", "Other", strict=True)
    with pytest.warns(UserWarning, match="1 rows repeat"):
        tables.read_parcels(spark, f"{tmp_path}/p.parquet", "M", strict=True)


def test_rows_replace_those_of_their_date_and_mill(spark, tmp_path):
    """In a database, twice: the second run leaves no duplicate."""
    rows = spark.createDataFrame([("a", dt.date(2024, 1, 1), "M", 1), ("b", dt.date(2024, 1, 2), "M", 1)], "id_parcela string, fecha_img date, ingenio string, v int")
    url, own = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    try:
        sinks.write_jdbc(rows, url, "published", properties=own)
    except Exception as e:
        if "Class" in str(e) or "driver" in str(e).lower():
            pytest.skip("no embedded database")
        raise
    sinks.write_jdbc(rows.where("id_parcela = 'b'").withColumn("v", F.lit(9)), url, "published", properties=own)
    got = spark.read.jdbc(url, "published", properties=own)
    assert sorted((r.id_parcela, r.v) for r in got.collect()) == [("a", 1), ("b", 9)]


def test_settings():
    s = config.Settings.read({"MILL": "Some_Mill", "REGION": "GT", "DATES": "2024-1-5, ,2024-01-06", "PUBLISH": "Yes"})
    assert s.mill == "Some Mill" and s.file_key == "Some_Mill" and s.dates == ["2024-1-5", "2024-01-06"] and s.publish
    with pytest.raises(ValueError, match="REGION"):
        config.Settings.read({"MILL": "x"})


def test_streams(spark, tmp_path):
    src, path = f"{tmp_path}/src", f"{tmp_path}/history"
    for i in range(7):
        spark.createDataFrame([("p", i, dt.date(2024, 1, 1 + i))], "id_parcela string, v int, fecha_deteccion date").write.mode("append").parquet(src)
        q = stream_history(spark.readStream.schema("id_parcela string, v int, fecha_deteccion date").parquet(src), path, f"{tmp_path}/cp", ["id_parcela"]).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 3, 4, 5, 6]
    spark.createDataFrame([(dt.datetime(2024, 1, 1), 10, 5), (dt.datetime(2024, 1, 2), 10, 1), (dt.datetime(2024, 2, 1), 4, 4)], "ts timestamp, total int, cloud int").write.parquet(f"{tmp_path}/scenes")
    w = cloud_windows(spark.readStream.schema("ts timestamp, total int, cloud int").parquet(f"{tmp_path}/scenes"))
    q = w.writeStream.format("memory").queryName("clouds").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.total, r.cloud_pct) for r in spark.sql("select * from clouds").collect())
    assert got == [(4, 100.0), (20, 30.0)]


def test_history_scan(spark, tmp_path):
    assert tables.read_history(spark, f"{tmp_path}/none") is None
    rows = spark.createDataFrame([("a", "Mill_A", dt.date(2024, 1, 1)), ("b", "Other", dt.date(2024, 1, 2))], "id_parcela string, ingenio string, fecha_deteccion date")
    sinks.write_history(rows, f"{tmp_path}/h")
    assert [r.id_parcela for r in tables.read_history(spark, f"{tmp_path}/h", "mill a").collect()] == ["a"]
    assert tables.read_history(spark, f"{tmp_path}/h").count() == 2
