"""What larger tables brought to light: plans that gather too much, rows that go missing, rows that come twice."""

import duckdb
from pyspark.sql import functions as F

from tests.test_registry import plain
from verdance.plans import products, registry

DATA = "/root/testdata/sf0.001"


def test_decoded_cells_are_not_broadcast(spark):
    # small files hold many cells, so their bytes would make Spark broadcast all of them
    plan = registry.queries()["geotiff_round_trip"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_catalogue_answers_are_whole(spark, tmp_path):
    # enough rows for several tasks, so that answers would share a line
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.range(0, 5000, 1, 16).selectExpr("id AS o_orderkey", "id * 1.5D AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
        got = registry.queries()["catalogue_scan"](spark, str(tmp_path))
        assert sorted(int(r.product_id) for r in got.collect()) == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_previews_need_a_complete_date(spark, tmp_path):
    # from 1997-03-01 on no day reaches 40 %, as on large tables, where shares lie close to their mean
    def compared(name, share):
        at = f"{tmp_path}/{name}"
        spark.range(0, 4000).selectExpr("id AS o_orderkey", "timestamp_ntz'1997-01-01 00:00:00' + make_dt_interval(CAST(id % 100 AS INT)) AS o_orderdate", f"CASE WHEN id % 100 < {share} OR id % 400 < 100 THEN 'O' ELSE 'F' END AS o_orderstatus").write.parquet(f"{at}/orders.parquet")
        spark.range(0, 50).selectExpr("timestamp_ntz'1997-01-01 00:00:00' + make_dt_interval(CAST(id * 3 AS INT)) AS l_shipdate").write.parquet(f"{at}/lineitem.parquet")
        got = registry.queries()["scenes_after_preview"](spark, at).toPandas()
        duck = duckdb.connect()
        for t in ("orders", "lineitem"):
            duck.execute(f"create view {t} as select * from '{at}/{t}.parquet/*.parquet'")
        want = duck.execute(registry.oracle_sql()["scenes_after_preview"]).df()
        assert plain(got) == plain(want)
        return len(got)

    assert compared("none", 59) == 0
    assert compared("some", 70) == 6


def test_potential_of_zero_and_repeated_cells(spark, tmp_path):
    # supplier 600 begins on the day itself, so its potential is 0; event 60005 is nodata in it, and comes twice with others
    at = str(tmp_path)
    spark.createDataFrame([(600,), (601,), (11,)], "s_suppkey long").coalesce(1).write.parquet(f"{at}/supplier.parquet")
    ids = [*range(60000, 60030), *range(60100, 60130), *range(60200, 60230)]
    rows = [(i, "error" if i % 5 == 0 else "view", float(i % 7)) for i in [*ids, *ids[:40]]] + [(None, "view", 1.0)]
    spark.createDataFrame(rows, "event_id long, event_type string, value double").coalesce(1).write.parquet(f"{at}/events.parquet")
    got = registry.queries()["potential_class_raster"](spark, at).toPandas()
    duck = duckdb.connect()
    for t in ("supplier", "events"):
        duck.execute(f"create view {t} as select * from '{at}/{t}.parquet/*.parquet'")
    want = duck.execute(registry.oracle_sql()["potential_class_raster"]).df()
    assert plain(got) == plain(want) and len(got) == len(rows)
    assert set(got[(got.row == 600) & (got.col == 5)].value) == {1}


def test_share_of_nodata_is_nodata(spark):
    # the operator itself keeps nodata, as the raster calculator does
    cells = spark.createDataFrame([(0, 0, None), (0, 1, 0.5)], "row long, col long, value double")
    parts = F.array(F.array(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 1.0), (0.0, 0.0))])))
    zones = spark.range(1).select(F.lit("a").alias("id_parcela"), parts.alias("parts"), F.lit(0.0).alias("potencial"))
    grid = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
    read = lambda **more: {r.col: r.value for r in products.potential_classes(cells, zones, grid, 8.0, **more).collect()}
    assert read() == {0: None, 1: 1} and read(zero_first=True) == {0: 1, 1: 1}
