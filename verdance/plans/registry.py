"""Every operator outside the llm subpackage as a registered query on the neutral tables, with SQL beside it.

Columns of the tables stand in for domain ones: a supplier for a parcel, a discount for
an index value, a quantity for an area, events on a 100-wide grid for pixels, an event
type for a scene class.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance import session
from verdance.functions import geometry as G
from verdance.functions import scalar as S
from verdance.functions import tables as K
from verdance.operators import curves as C
from verdance.operators import publish as P
from verdance.operators import raster as R
from verdance.operators import scenes as N
from verdance.operators import sync as Y
from verdance.operators import temporal as T
from verdance.operators import zonal as Z
from verdance.sources import sinks

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
RANGES = [(0.0, 0.02, 1), (0.02, 0.05, 2), (0.05, 0.08, 3), (0.08, 1.0, 4)]
CASE = "CASE WHEN {0} >= 0.08 AND {0} < 1.0 THEN 4 WHEN {0} >= 0.05 AND {0} < 0.08 THEN 3 WHEN {0} >= 0.02 AND {0} < 0.05 THEN 2 WHEN {0} >= 0.0 AND {0} < 0.02 THEN 1 END"
#: events as a grid: SCL from the type, VAL null for errors.
GRID = "(SELECT event_id // 100 AS \"row\", event_id % 100 AS col, event_type, value FROM events)"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.ship(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        _QUERIES[f.__name__] = run
        if sql:
            _SQL[f.__name__] = sql
        return run

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from verdance.plans import programs  # noqa: F401, registers its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from verdance.plans import programs  # noqa: F401

    return dict(_SQL)


def _grid(read: Callable[[str], DataFrame], scl: dict[str, int] | None = None) -> DataFrame:
    e = read("events").select(F.floor(F.col("event_id") / 100).cast("long").alias("row"), (F.col("event_id") % 100).alias("col"), "event_type", "value")
    if scl:
        code = F.lit(None).cast("int")
        for k, v in scl.items():
            code = F.when(F.col("event_type") == k, v).otherwise(code)
        e = e.withColumn("SCL", code)
    return e


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


@query(f"""
WITH l AS (SELECT l_suppkey AS zone, l_discount AS v, l_quantity AS a, {CASE.format('l_discount')} AS k FROM lineitem),
s AS (SELECT zone, round(avg(v), 8) AS mean, round(stddev_pop(v), 8) AS stdv, min(v) AS "min", max(v) AS "max", round(median(v), 8) AS median FROM l GROUP BY zone),
p AS (SELECT zone, coalesce(sum(a) FILTER (k = 1), 0.0) AS c1, coalesce(sum(a) FILTER (k = 2), 0.0) AS c2, coalesce(sum(a) FILTER (k = 3), 0.0) AS c3, coalesce(sum(a) FILTER (k = 4), 0.0) AS c4 FROM l WHERE k IS NOT NULL GROUP BY zone)
SELECT s.zone, mean, stdv, "min", "max", median, c1, c2, c3, c4 FROM s LEFT JOIN p ON s.zone = p.zone""")
def class_pivot(read):
    cells = read("lineitem").select(F.col("l_suppkey").alias("zone"), F.col("l_discount").alias("v"), F.col("l_quantity").alias("a"), S.reclassify(F.col("l_discount"), RANGES).alias("gridcode"))
    stats = _round(Z.zonal_stats(cells, "zone", "v"), 8, "mean", "stdv", "median")
    return stats.join(Z.class_pivot(Z.class_area(cells, "zone", area="a", unit=1.0), "zone", [1, 2, 3, 4], "c"), "zone", "left")


@query("SELECT l_suppkey AS zone, round(avg(l_discount), 8) AS mean, round(stddev_pop(l_discount), 8) AS stdv, min(l_discount) AS \"min\", max(l_discount) AS \"max\", round(median(l_discount), 8) AS median FROM lineitem GROUP BY 1")
def zonal_stats(read):
    return _round(Z.zonal_stats(read("lineitem").select(F.col("l_suppkey").alias("zone"), "l_discount"), "zone", "l_discount"), 8, "mean", "stdv", "median")


@query(f"SELECT l_suppkey AS zone, {CASE.format('l_discount')} AS gridcode, round(sum(l_quantity) / 10000.0, 6) AS area FROM lineitem WHERE {CASE.format('l_discount')} IS NOT NULL GROUP BY 1, 2")
def class_area(read):
    cells = read("lineitem").select(F.col("l_suppkey").alias("zone"), S.reclassify(F.col("l_discount"), RANGES).alias("gridcode"), F.col("l_quantity").alias("overlap"))
    return _round(Z.class_area(cells, "zone"), 6, "area")


@query(f"SELECT l_discount, {CASE.format('l_discount')} AS k, CASE WHEN CAST(l_discount AS FLOAT) >= CAST(0.08 AS FLOAT) THEN 2 WHEN CAST(l_discount AS FLOAT) >= CAST(0.03 AS FLOAT) THEN 1 END AS k32, count(*) AS n FROM lineitem GROUP BY ALL")
def reclassify(read):
    k32 = S.reclassify(F.col("l_discount").cast("float"), [(0.03, 0.08, 1), (0.08, 1.0, 2)], "float")
    return read("lineitem").groupBy("l_discount", S.reclassify(F.col("l_discount"), RANGES).alias("k"), k32.alias("k32")).agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE least(date_diff('day', CAST(o_orderdate AS DATE), DATE '1996-06-01'), 450) END AS age FROM orders)
SELECT o_orderkey, CAST(age AS INT) AS age, CASE WHEN age IS NULL THEN 'SF' WHEN age <= 60 THEN 'Iniciacion' WHEN age <= 120 THEN 'Macollamiento' WHEN age <= 210 THEN 'Elongacion I' WHEN age <= 300 THEN 'Elongacion II' ELSE 'Maduracion' END AS stage FROM a""")
def age_stage(read):
    start = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    rows = read("orders").select("o_orderkey", S.age_days(F.lit("1996-06-01").cast("date"), start).alias("age"))
    return rows.withColumn("stage", S.growth_stage(F.col("age")))


_ALGEBRA = """
SELECT a.l_orderkey, a.l_linenumber, round(CASE WHEN b.l_tax = 0 THEN 0 ELSE a.l_discount / b.l_tax END, 6) AS divide, round(a.l_discount * b.l_tax, 6) AS multiply, round(a.l_discount + b.l_tax, 6) AS "add", round(a.l_discount - b.l_tax, 6) AS subtract
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber"""


@query(_ALGEBRA)
def raster_algebra(read):
    keys = ["l_orderkey", "l_linenumber"]
    a = read("lineitem").select(*keys, F.col("l_discount").alias("a"))
    b = read("lineitem").select(*keys, F.col("l_tax").alias("b"))
    both = a.join(b, keys)
    return both.select(*keys, *[F.round(S.raster_math(F.col("a"), F.col("b"), op), 6).alias(op) for op in ("divide", "multiply", "add", "subtract")])


@query("""
SELECT coalesce(a.event_id, b.event_id) AS "row", round(CASE WHEN a.value IS NULL OR b.value IS NULL THEN NULL WHEN b.value = 0 THEN 0 ELSE a.value / b.value END, 6) AS value
FROM (SELECT event_id, value FROM events WHERE event_type <> 'view') a FULL JOIN (SELECT event_id, value FROM events WHERE event_type <> 'click') b ON a.event_id = b.event_id""")
def raster_ratio(read):
    e = read("events").select(F.col("event_id").alias("row"), "event_type", "value")
    return _round(R.calculate(e.where("event_type <> 'view'"), e.where("event_type <> 'click'"), "divide", ["row"]), 6, "value")


@query(f"SELECT l_orderkey, l_linenumber, 12 * {CASE.format('l_discount')} + 8 * {CASE.format('l_tax')} AS score FROM lineitem")
def smart_growth(read):
    return read("lineitem").select("l_orderkey", "l_linenumber", S.smart_growth(S.reclassify(F.col("l_discount"), RANGES), S.reclassify(F.col("l_tax"), RANGES)).alias("score"))


@query("""
WITH s AS (SELECT l_suppkey AS zone, avg(l_discount) + 1.5 * stddev_pop(l_discount) AS t, sum(l_quantity) AS area FROM lineitem GROUP BY 1),
w AS (SELECT zone, sum(l_quantity) AS weed FROM lineitem JOIN s ON l_suppkey = zone WHERE t > 0 AND t < 1 AND l_discount > t + 1e-9 GROUP BY zone)
SELECT s.zone, round(t, 8) AS threshold, coalesce(weed, 0.0) AS area_maleza, area AS area_parcela,
 CASE WHEN area > 0 THEN round_even(coalesce(weed, 0.0) / area * 100, 2) ELSE 0.0 END AS percent_maleza,
 CASE WHEN round_even(coalesce(weed, 0.0) / area * 100, 2) >= 15 THEN 'Critica' ELSE 'Evaluar' END AS status FROM s LEFT JOIN w ON s.zone = w.zone""")
def weed_threshold(read):
    cells = read("lineitem").select(F.col("l_suppkey").alias("zone"), "l_discount", "l_quantity")
    stats = Z.zonal_stats(cells, "zone", "l_discount").select("zone", S.weed_threshold(F.col("mean"), F.col("stdv")).alias("t"))
    area = cells.groupBy("zone").agg(F.sum("l_quantity").alias("area_parcela"))
    weed = cells.join(stats.where(S.valid_threshold(F.col("t"))), "zone").where(F.col("l_discount") > F.col("t") + 1e-9).groupBy("zone").agg(F.sum("l_quantity").alias("w"))
    out = stats.join(area, "zone").join(weed, "zone", "left").withColumn("area_maleza", F.coalesce("w", F.lit(0.0)))
    out = out.withColumn("percent_maleza", S.weed_percent(F.col("area_maleza"), F.col("area_parcela")))
    return out.select("zone", F.round("t", 8).alias("threshold"), "area_maleza", "area_parcela", "percent_maleza", S.weed_status(F.col("percent_maleza")).alias("status"))


@query("""
WITH l AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), r AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS s FROM lineitem),
x AS (SELECT d, s, row_number() OVER (PARTITION BY d ORDER BY abs(date_diff('day', s, d)), s DESC) AS n FROM l CROSS JOIN r)
SELECT d AS s2_date, s AS s1_date, CAST(abs(date_diff('day', s, d)) AS INT) AS s1_diff_days FROM x WHERE n = 1""")
def nearest_date_join(read):
    left = read("orders").select(F.to_date("o_orderdate").alias("s2_date")).distinct()
    right = read("lineitem").select(F.to_date("l_shipdate").alias("s")).distinct()
    return T.nearest_date(left, right, "s2_date", "s", "s1_date", "s1_diff_days")


@query("SELECT o_custkey AS id_parcela, o_orderkey, zafra FROM (SELECT *, year(o_orderdate) AS zafra, row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey DESC) AS n FROM orders WHERE year(o_orderdate) < 1997) WHERE n = 1")
def past_record_top1(read):
    rows = read("orders").select(F.col("o_custkey").alias("id_parcela"), "o_orderkey", F.year("o_orderdate").cast("string").alias("zafra"))
    number = F.col("zafra").try_cast("int")
    return T.top_by(rows.where(number < 1997), ["id_parcela"], [number.desc(), F.desc("o_orderkey")]).withColumn("zafra", F.col("zafra").cast("long"))


@query("""
WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN CAST(o_orderkey % 4 AS VARCHAR) ELSE CAST(o_orderkey % 4 AS VARCHAR) || '.0' END AS c, o_custkey FROM orders),
w AS (SELECT o_orderkey, c, lag(c) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM o)
SELECT o_orderkey, CASE WHEN c IS NULL THEN 'ok_empty' WHEN p IS NULL THEN 'ok_no_past' WHEN CAST(c AS DOUBLE) = CAST(p AS DOUBLE) + 1 THEN 'ok_next' WHEN CAST(c AS DOUBLE) = 0 THEN 'ok_restart' ELSE 'invalid_jump' END AS verdict FROM w""")
def cycle_transition(read):
    from pyspark.sql import Window

    n = (F.col("o_orderkey") % 4).cast("string")
    c = F.when(F.col("o_orderstatus") == "F", n).when(F.col("o_orderstatus") != "P", F.concat(n, F.lit(".0")))
    rows = read("orders").select("o_orderkey", "o_custkey", c.alias("c"))
    past = F.lag("c").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return rows.withColumn("p", past).select("o_orderkey", S.cycle_check(F.col("p"), F.col("c")).alias("verdict"))


@query("""
WITH o AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS st FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey AS k, o_totalprice + 1 AS price, CASE WHEN o_orderkey % 2 = 0 THEN 'N' END AS st FROM orders WHERE o_orderkey % 5 <> 0)
SELECT coalesce(n.k, o.k) AS k, coalesce(n.price, o.price) AS price, coalesce(n.st, o.st) AS st, CASE WHEN o.k IS NULL THEN 'inserted' WHEN n.k IS NULL THEN 'kept' ELSE 'updated' END AS action FROM o FULL JOIN n ON o.k = n.k""")
def sync_merge(read):
    o = read("orders")
    old = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("st"))
    new = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") + 1).alias("price"), F.when(F.col("o_orderkey") % 2 == 0, "N").alias("st"))
    return Y.merge(old, new, ["k"])


@query("""
WITH c AS (SELECT p_size AS x0, avg(p_retailprice) AS y0 FROM part WHERE p_size % 4 = 0 AND p_size BETWEEN 8 AND 40 GROUP BY 1), k AS (SELECT x0, y0, lead(x0) OVER (ORDER BY x0) AS x1, lead(y0) OVER (ORDER BY x0) AS y1, min(x0) OVER () AS lo, max(x0) OVER () AS hi FROM c)
SELECT p_partkey, p_size, round(CASE WHEN p_size <= lo OR x1 IS NULL THEN y0 ELSE y0 + (p_size - x0) / (x1 - x0) * (y1 - y0) END, 6) AS potencial FROM part JOIN k ON (p_size >= x0 OR x0 = lo) AND (p_size < x1 OR x1 IS NULL)""")
def curve_interp(read):
    part = read("part")
    curve = part.where("p_size % 4 = 0 AND p_size BETWEEN 8 AND 40").groupBy("p_size").agg(F.avg("p_retailprice").alias("y")).withColumnRenamed("p_size", "x")
    return _round(C.interpolate(part.select("p_partkey", "p_size"), curve, "p_size", "x", "y", "potencial"), 6, "potencial")


def _horner(c: list[float]) -> str:
    out = repr(c[0])
    for k in c[1:]:
        out = f"({out} * a + {k!r})"
    return out


_REGIONS = ["GT", "NI", "MX06", "MX07", "MX02", "none"]


def _by_region(index: str) -> str:
    return "CASE region " + " ".join(f"WHEN '{r}' THEN {_horner(K.POTENTIAL[r, index])}" for r in _REGIONS[:-1]) + " END"


@query(f"""
WITH x AS (SELECT o_orderkey, CAST(o_orderkey % 451 AS DOUBLE) AS a, {_REGIONS!r}[o_orderkey % 6 + 1] AS region FROM orders)
SELECT o_orderkey, region, round({_by_region('NDRE')}, 9) AS ndre, round({_by_region('NDWI')}, 9) AS ndwi FROM x""".replace("e-", "E-"))
def potential_poly(read):
    region = F.element_at(F.array(*map(F.lit, _REGIONS)), (F.col("o_orderkey") % 6 + 1).cast("int"))
    rows = read("orders").select("o_orderkey", region.alias("region"), (F.col("o_orderkey") % 451).alias("a"))
    return rows.select("o_orderkey", "region", F.round(S.potential(F.col("region"), "NDRE", F.col("a")), 9).alias("ndre"), F.round(S.potential(F.col("region"), "NDWI", F.col("a")), 9).alias("ndwi"))


@query("""
WITH e AS (SELECT user_id, CAST(event_id % 40 AS DOUBLE) AS x, value AS v, event_type = 'error' AS cloud FROM events), w AS (SELECT user_id, x, v, CASE WHEN NOT cloud AND v IS NOT NULL THEN 1 / greatest(x, 1) END AS w FROM e),
s AS (SELECT user_id, count(w) AS n, sum(w) AS sw, sum(w * x) AS sx, sum(w * v) AS sy, sum(w * x * x) AS sxx, sum(w * x * v) AS sxy FROM w GROUP BY 1),
d AS (SELECT *, sw * sxx - sx * sx AS den FROM s), l AS (SELECT *, CASE WHEN abs(den) > 1e-10 THEN greatest(-500, least(500, (sw * sxy - sx * sy) / den)) END AS slope FROM d)
SELECT user_id, round(CASE WHEN n = 1 THEN sy / greatest(sw, 1e-10) WHEN n > 1 THEN greatest(CASE WHEN abs(den) > 1e-10 THEN (sy - slope * sx) / sw ELSE sy / greatest(sw, 1e-10) END, 0) END, 5) AS value FROM l""")
def temporal_wls_fill(read):
    rows = read("events").select("user_id", (F.col("event_id") % 40).alias("days"), (F.col("event_type") == "error").alias("cloud"), "value")
    return _round(R.temporal_fill(rows, ["value"], ["user_id"]), 5, "value")


@query("SELECT user_id, count(*) AS total, count(*) FILTER (event_type IN ('error', 'view')) AS cloud, count(*) FILTER (event_type NOT IN ('error', 'view')) AS clear, round(100.0 * count(*) FILTER (event_type IN ('error', 'view')) / count(*), 6) AS cloud_pct FROM events GROUP BY 1")
def cloud_stats(read):
    scl = F.when(F.col("event_type") == "error", 9).when(F.col("event_type") == "view", 3).otherwise(4)
    return _round(R.cloud_stats(read("events").select("user_id", scl.alias("SCL")), ["user_id"]), 6, "cloud_pct")


@query("""SELECT user_id, round(100.0 * count(*) FILTER (event_type = 'error') / count(*), 6) AS nodata_pct, round(100.0 * count(*) FILTER (event_type = 'view') / count(*), 6) AS cloud_pct, round(100.0 * count(*) FILTER (event_type = 'click') / count(*), 6) AS valid_pct, 100.0 * count(*) FILTER (event_type = 'error') / count(*) < 10 AS is_complete FROM events GROUP BY 1""")
def preview_stats(read):
    scl = F.when(F.col("event_type") == "error", 255).when(F.col("event_type") == "view", 9).when(F.col("event_type") == "click", 5).otherwise(11)
    return _round(R.preview_stats(read("events").select("user_id", scl.alias("SCL")), ["user_id"]), 6, "nodata_pct", "cloud_pct", "valid_pct")


@query(f"""
WITH g AS (SELECT "row", col, event_type = 'error' AND col % 9 = 4 AS cloud FROM {GRID}),
o AS (SELECT r, c FROM generate_series(-5, 5) a(r), generate_series(-5, 5) b(c) WHERE abs(r) + abs(c) <= 5),
n AS (SELECT DISTINCT g."row" + r AS "row", col + c AS col FROM g, o WHERE cloud)
SELECT g."row", g.col, cloud, n."row" IS NOT NULL AS buffered FROM g LEFT JOIN n ON g."row" = n."row" AND g.col = n.col""")
def cloud_dilation(read):
    g = _grid(read).withColumn("SCL", F.when((F.col("event_type") == "error") & (F.col("col") % 9 == 4), 9).otherwise(4))
    return R.cloud_mask(g, 5).select("row", "col", "cloud", "buffered")


@query(f"""
WITH g AS (SELECT "row", col FROM {GRID} WHERE event_type = 'error' AND col % 9 = 4), o AS (SELECT r, c, sqrt(r * r + c * c) AS d FROM generate_series(-5, 5) a(r), generate_series(-5, 5) b(c))
SELECT "row" + r AS "row", col + c AS col, round(max(1 - d / 5), 9) AS weight FROM g, o WHERE d < 5 GROUP BY 1, 2""")
def blend_weights(read):
    g = _grid(read).withColumn("cloud", (F.col("event_type") == "error") & (F.col("col") % 9 == 4))
    return _round(R.blend_weights(g), 9, "weight")


@query(f"""
WITH g AS (SELECT "row", col, value AS v FROM {GRID}), m AS (SELECT max("row") AS h, max(col) AS w FROM g), o AS (SELECT r, c FROM generate_series(-1, 1) a(r), generate_series(-1, 1) b(c)),
t AS (SELECT tr, tc, CASE WHEN tr + r < 0 THEN -1 - tr - r WHEN tr + r > h THEN 2 * h + 1 - tr - r ELSE tr + r END AS sr, CASE WHEN tc + c < 0 THEN -1 - tc - c WHEN tc + c > w THEN 2 * w + 1 - tc - c ELSE tc + c END AS sc
 FROM m, generate_series(0, (SELECT h FROM m)) a(tr), generate_series(0, (SELECT w FROM m)) b(tc), o)
SELECT tr AS "row", tc AS col, round(sum(v) / 9, 5) AS mean, round(greatest(0, sum(v * v) / 9 - (sum(v) / 9) * (sum(v) / 9)), 3) AS variance FROM t JOIN g ON sr = g."row" AND sc = g.col GROUP BY 1, 2""")
def focal_mean_var(read):
    return R.focal(_grid(read), 1).select("row", "col", F.round("mean", 5).alias("mean"), F.round("variance", 3).alias("variance"))


@query(f"""
WITH g AS (SELECT "row", col, CASE WHEN event_type <> 'error' THEN value END AS v FROM {GRID}), h AS (SELECT "row" AS r2, col AS c2, v AS v2 FROM g WHERE v IS NOT NULL),
x AS (SELECT "row", col, v2, row_number() OVER (PARTITION BY "row", col ORDER BY ("row" - r2) * ("row" - r2) + (col - c2) * (col - c2), r2, c2) AS n FROM g JOIN h ON abs("row" - r2) <= 50 AND abs(col - c2) <= 50 AND ("row" - r2) * ("row" - r2) + (col - c2) * (col - c2) <= 2500 WHERE v IS NULL)
SELECT g."row", g.col, coalesce(g.v, x.v2) AS value FROM g LEFT JOIN x ON g."row" = x."row" AND g.col = x.col AND n = 1""")
def nearest_fill(read):
    return R.nearest_fill(_grid(read).select("row", "col", F.when(F.col("event_type") != "error", F.col("value")).alias("value")))


@query("""SELECT l_orderkey, l_linenumber, round(greatest(-1, least(1, (l_quantity - l_tax * 100) / (l_quantity + l_tax * 100 + 1e-6))), 8) + 0.0 AS ndre, round(greatest(-1, least(1, (l_quantity - l_discount * 100) / (l_quantity + l_discount * 100 + 1e-6))), 8) + 0.0 AS ndwi FROM lineitem""")
def index_ndre_ndwi(read):
    q = F.col("l_quantity")
    return read("lineitem").select("l_orderkey", "l_linenumber", (F.round(S.ndre(q, F.col("l_tax") * 100), 8) + 0.0).alias("ndre"), (F.round(S.ndwi(q, F.col("l_discount") * 100), 8) + 0.0).alias("ndwi"))


@query("""
WITH x AS (SELECT o_custkey, count(*) AS prev, 100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*) AS cloud_pct, 100.0 * count(*) FILTER (o_orderstatus = 'P') / count(*) AS nodata_pct, CAST(count(*) AS DOUBLE) AS cloud, count(*) FILTER (o_orderpriority LIKE '1%') AS t, count(*) FILTER (o_orderpriority LIKE '2%') AS f, count(*) FILTER (o_orderpriority LIKE '3%') AS s FROM orders GROUP BY 1),
c AS (SELECT *, CASE WHEN prev >= 5 THEN 100 WHEN prev = 4 THEN 90 WHEN prev = 3 THEN 75 WHEN prev = 2 THEN 55 WHEN prev = 1 THEN 30 ELSE 5 END AS p1, CASE WHEN cloud_pct <= 0 THEN 100 WHEN cloud_pct >= 100 THEN 5 ELSE greatest(5, 100 - 0.8 * pow(cloud_pct, 1.3)) END AS p2, CASE WHEN nodata_pct <= 0 THEN 100 WHEN nodata_pct >= 50 THEN 5 ELSE greatest(5, 100 - 2 * nodata_pct) END AS p3, least(100, greatest(5, (100 * t + 75 * f + 40 * s) / cloud)) AS p4 FROM x),
o AS (SELECT *, least(100, greatest(0, 0.30 * p1 + 0.25 * p2 + 0.30 * p4 + 0.15 * p3)) AS total FROM c)
SELECT o_custkey, round(CAST(total AS DOUBLE), 6) AS confidence_overall, CASE WHEN total >= 85 THEN 'HIGH' WHEN total >= 65 THEN 'MEDIUM' WHEN total >= 40 THEN 'LOW' WHEN total >= 20 THEN 'VERY LOW' ELSE 'MINIMAL' END AS confidence_level FROM o""")
def confidence(read):
    has = lambda p: F.count_if(F.col("o_orderpriority").startswith(p))
    x = read("orders").groupBy("o_custkey").agg(F.count("*").alias("prev"), (100.0 * F.count_if(F.col("o_orderstatus") == "F") / F.count("*")).alias("cp"), (100.0 * F.count_if(F.col("o_orderstatus") == "P") / F.count("*")).alias("np"), F.count("*").cast("double").alias("cloud"), has("1").alias("t"), has("2").alias("f"), has("3").alias("s"))
    c = S.confidence(F.col("prev"), F.col("cp"), F.col("np"), F.col("cloud"), F.col("t"), F.col("f"), F.col("s"))
    return x.select("o_custkey", F.round(c["confidence_overall"], 6).alias("confidence_overall"), c["confidence_level"].alias("confidence_level"))


@query("""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, 100.0 * count(*) FILTER (o_orderstatus = 'O') / count(*) AS cov FROM orders GROUP BY 1), i AS (SELECT coalesce(max(date) FILTER (date BETWEEN DATE '1997-03-01' AND DATE '1997-03-30' AND cov >= 95), (SELECT date FROM d WHERE date BETWEEN DATE '1997-03-01' AND DATE '1997-03-30' AND cov > 0 ORDER BY cov DESC, date LIMIT 1), max(date) FILTER (date < DATE '1997-03-01' AND cov >= 95)) AS date FROM d),
p AS (SELECT d.date, row_number() OVER (ORDER BY d.date DESC) AS slot FROM d, i WHERE d.date < i.date AND cov >= 95), r AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS s FROM lineitem),
c AS (SELECT date, 0 AS slot FROM i WHERE date IS NOT NULL UNION ALL SELECT date, slot FROM p WHERE slot <= 5),
x AS (SELECT date, slot, s, row_number() OVER (PARTITION BY date ORDER BY abs(date_diff('day', s, date)), s DESC) AS n FROM c CROSS JOIN r)
SELECT date, CAST(slot AS INT) AS slot, CASE WHEN slot = 0 THEN 'inference' ELSE 'prev' || lpad(CAST(slot AS VARCHAR), 2, '0') END AS role, s AS s1_date, CAST(abs(date_diff('day', s, date)) AS INT) AS s1_diff_days FROM x WHERE n = 1""")
def scene_selection(read):
    days = read("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg((100.0 * F.count_if(F.col("o_orderstatus") == "O") / F.count("*")).alias("coverage_pct")).withColumn("is_complete", F.col("coverage_pct") >= N.COVERAGE)
    radar = read("lineitem").select(F.to_date("l_shipdate").alias("date_s1")).distinct()
    return N.select_scenes(days, radar, F.lit("1997-03-01").cast("date"), F.lit("1997-03-30").cast("date")).select("date", "slot", "role", "s1_date", "s1_diff_days")


@query("SELECT user_id, round(median(value), 8) AS value FROM events WHERE CAST(ts AS DATE) BETWEEN (SELECT max(CAST(ts AS DATE)) FROM events) - 60 AND (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1")
def composite_median(read):
    e = read("events").select("user_id", F.to_date("ts").alias("scene_date"), "value")
    last = e.agg(F.max("scene_date").alias("last"))
    return _round(R.median_composite(e.crossJoin(F.broadcast(last)), F.col("last"), ["value"], 60, ["user_id"]), 8, "value")


@query("""
WITH f AS (SELECT CASE event_type WHEN 'click' THEN 'GT_X_DATA_NDVI_A.parquet' WHEN 'view' THEN 'GT_X_DATA_NDWI_A.parquet' WHEN 'purchase' THEN 'GT_X_DATA_SMART_GROWTH_A.parquet' WHEN 'signup' THEN 'GT_X_DATA_WEED_A.parquet' ELSE 'other.parquet' END AS f, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM events),
t AS (SELECT f, v, CASE WHEN f LIKE '%NDVI%' THEN 'data_ndvi' WHEN f LIKE '%NDWI%' THEN 'data_ndwi' WHEN f LIKE '%SMART%' THEN 'data_sg' WHEN f LIKE '%WEED%' THEN 'data_maleza' END AS table_name FROM f)
SELECT table_name, count(DISTINCT f) AS files, count(*) AS "rows", count(v) AS clean, count(*) - count(v) AS dropped, round(100.0 * (count(*) - count(v)) / count(*), 2) AS drop_pct FROM t WHERE table_name IS NOT NULL GROUP BY ROLLUP (table_name)""")
def push_stats(read):
    name = F.when(F.col("event_type") == "click", "GT_X_DATA_NDVI_A.parquet").when(F.col("event_type") == "view", "GT_X_DATA_NDWI_A.parquet").when(F.col("event_type") == "purchase", "GT_X_DATA_SMART_GROWTH_A.parquet").when(F.col("event_type") == "signup", "GT_X_DATA_WEED_A.parquet").otherwise("other.parquet")
    return P.push_stats(read("events").select(name.alias("file_name"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v")), ["v"])


@query("""SELECT 'SMART_GROWTH' AS product, count(*) AS "rows", count(*) FILTER (event_type = 'error') AS null_ages, CAST(0 AS BIGINT) AS null_means, min(value) FILTER (value > 0) AS sg_low, max(value) FILTER (value > 0) AS sg_high, count(*) FILTER (event_type = 'view') AS critical, round(100.0 * count(*) FILTER (event_type = 'error') / count(*), 6) AS null_age_pct, '' AS missing FROM events
UNION ALL SELECT 'NDVI', count(*), count(*), count(*) FILTER (event_type = 'click'), NULL, NULL, 0, 100.0, 'ndvi_2' FROM events""")
def audit(read):
    """Growth scores with all columns, and indices without ages and a class."""
    rows = read("events").select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("edad"), F.col("value").alias("sg_mean"), F.when(F.col("event_type") == "view", "Critica").alias("status_maleza"))
    other = read("events").select(F.when(F.col("event_type") != "click", F.col("value")).alias("ndvi_mean"), F.lit(0.0).alias("ndvi_1"))
    out = P.audit(rows, "SMART_GROWTH").unionByName(P.audit(other, "NDVI"))
    return _round(out, 6, "null_age_pct").withColumn("missing", F.array_join("missing_columns", ",")).drop("missing_columns")


@query("""
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, event_id FROM events), r AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY d DESC) AS k FROM e)
SELECT user_id, d AS fecha_deteccion, event_id FROM r WHERE k <= 5""")
def history_last5(read):
    e = read("events").select("user_id", F.to_date("ts").alias("fecha_deteccion"), "event_id")
    newest = e.agg(F.max("fecha_deteccion").alias("m"))
    # the newest date comes as the current batch; it replaces what history has of it
    now = e.join(F.broadcast(newest), F.col("fecha_deteccion") == F.col("m")).drop("m")
    return T.bounded_history(e, now, "fecha_deteccion", ["user_id"])


@query("SELECT user_id, least(count(DISTINCT CAST(ts AS DATE)), 5) AS overlap_count FROM events GROUP BY 1")
def overlap_count(read):
    return T.overlap_count(read("events").select("user_id", F.to_date("ts").alias("d")), ["user_id"], "d").withColumn("overlap_count", F.col("overlap_count").cast("long"))


@query("SELECT user_id, least(count(*), 5) AS overlap_count FROM events GROUP BY 1")
def overlap_count_piece(read):
    return T.overlap_count(read("events"), ["user_id"]).withColumn("overlap_count", F.col("overlap_count").cast("long"))


@query("""
WITH p AS (SELECT page_id, 'S2A_MSIL2A_' || strftime(DATE '2024-01-01' + CAST(page_id % 300 AS INT), '%Y%m%d') || 'T161829_N0509_T' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || 'PYS_x.SAFE' AS n FROM pages)
SELECT page_id, CAST(strptime(regexp_extract(n, '_(\\d{8})T\\d{6}_', 1), '%Y%m%d') AS DATE) AS scene_date, regexp_extract(n, '_T(\\d{2}[A-Z]{3})_', 1) AS tile FROM p""")
def filename_parse(read):
    n = F.concat(F.lit("S2A_MSIL2A_"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")), "yyyyMMdd"), F.lit("T161829_N0509_T"), F.lpad((F.col("page_id") % 60).cast("string"), 2, "0"), F.lit("PYS_x.SAFE"))
    return read("pages").select("page_id", S.scene_date(n).alias("scene_date"), S.tile_of(n).alias("tile"))


@query("""
WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'ndvi_PROD_2024-03-0' || CAST(page_id % 9 + 1 AS VARCHAR) || '.tif' WHEN 1 THEN 'cloud_free_ndvi_2024-03-01.tif' WHEN 2 THEN 'ndwi_2024031' || CAST(page_id % 9 AS VARCHAR) || '.tif' ELSE 'notes.txt' END AS n FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'GT_FARM_NDVI_2024_03_0' || CAST(page_id % 9 + 1 AS VARCHAR) || '.tif' WHEN 2 THEN 'GT_FARM_NDWI_2024_03_1' || CAST(page_id % 9 AS VARCHAR) || '.tif' END AS name FROM p""")
def rename_convention(read):
    k, n = F.col("page_id") % 4, F.col("page_id") % 9
    name = F.when(k == 0, F.concat(F.lit("dir/ndvi_PROD_2024-03-0"), (n + 1).cast("string"), F.lit(".tif"))).when(k == 1, "dir/cloud_free_ndvi_2024-03-01.tif").when(k == 2, F.concat(F.lit("dir/ndwi_2024031"), n.cast("string"), F.lit(".tif"))).otherwise("dir/notes.txt")
    return read("pages").select("page_id", sinks.published_name(name, "GT", "FARM").alias("name"))


@query("""
WITH x AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN ' 12.50 ' WHEN 1 THEN 'N/A' WHEN 2 THEN 'abc' WHEN 3 THEN 'inf' WHEN 4 THEN '-' WHEN 5 THEN CAST(event_id AS VARCHAR) WHEN 6 THEN 'Yes' ELSE '2024-1-5' END AS t FROM events)
SELECT event_id, CASE event_id % 8 WHEN 0 THEN 12.5 WHEN 5 THEN CAST(event_id AS DOUBLE) END AS num, CASE event_id % 8 WHEN 1 THEN NULL WHEN 4 THEN NULL WHEN 6 THEN TRUE ELSE trim(t) = '1' END AS bool, CASE event_id % 8 WHEN 7 THEN DATE '2024-01-05' END AS day, event_id % 8 = 3 AS infinite, CASE WHEN event_id % 8 IN (1, 4) THEN NULL ELSE trim(t) END AS text FROM x WHERE length(t) < 8 OR event_id % 8 <> 5""")
def record_coercion(read):
    k = F.col("event_id") % 8
    t = F.when(k == 0, " 12.50 ").when(k == 1, "N/A").when(k == 2, "abc").when(k == 3, "inf").when(k == 4, "-").when(k == 5, F.col("event_id").cast("string")).when(k == 6, "Yes").otherwise("2024-1-5")
    rows = read("events").select("event_id", t.alias("t")).where((F.length("t") < 8) | (k != 5))
    c = F.col("t")
    return rows.select("event_id", S.coerce_number(c).alias("num"), S.coerce_boolean(c).alias("bool"), S.parse_date(c).alias("day"), S.is_infinite(c).alias("infinite"), S.cleaned(c).alias("text"))


def _shape(x, y, w, h):
    """A rectangle with a hole of a quarter of its sides, as parts."""
    p = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    box = lambda x, y, w, h: F.array(p(x, y), p(x + w, y), p(x + w, y + h), p(x, y + h), p(x, y))
    return F.array(F.array(box(x, y, w, h), box(x + w / 4, y + h / 4, w / 4, h / 4)))


@query("SELECT p_partkey, CAST(p_size * 4.0 * 8 - p_size * 2.0 AS DOUBLE) AS area, CAST(p_partkey AS DOUBLE) AS west, CAST(p_partkey + p_size * 4.0 AS DOUBLE) AS east FROM part")
def polygon_area(read):
    shape = _shape(F.col("p_partkey").cast("double"), F.lit(0.0), F.col("p_size") * 4.0, F.lit(8.0))
    rows = read("part").select("p_partkey", shape.alias("parts"))
    b = G.bounds(F.col("parts"))
    return rows.select("p_partkey", F.round(G.shape_area(F.col("parts")), 6).alias("area"), b["west"].alias("west"), b["east"].alias("east"))


#: Suppliers as rectangles with a hole, ten to a band of ten rows, and the events that lie under each one's box.
_CELLS = """
WITH z AS (SELECT s_suppkey AS id, s_suppkey % 10 * 10 + 0.3 AS x, s_suppkey // 10 * 10 + 0.25 AS y, 7.0 AS w, 4.0 AS h FROM supplier),
c AS (SELECT event_id // 100 AS "row", event_id % 100 AS col, value FROM events),
u AS (SELECT z.*, unnest(generate_series(CAST(floor(y) AS BIGINT), CAST(floor(y + h) AS BIGINT))) AS r FROM z), b AS (SELECT u.*, unnest(generate_series(CAST(floor(x) AS BIGINT), CAST(floor(x + w) AS BIGINT))) AS k FROM u),
m AS (SELECT id, "row", col, value, greatest(0, least(col + 1, x + w) - greatest(col, x)) * greatest(0, least("row" + 1, y + h) - greatest("row", y)) - greatest(0, least(col + 1, x + w / 2) - greatest(col, x + w / 4)) * greatest(0, least("row" + 1, y + h / 2) - greatest("row", y + h / 4)) AS overlap,
 col + 0.5 > x AND col + 0.5 < x + w AND "row" + 0.5 > y AND "row" + 0.5 < y + h AND NOT (col + 0.5 > x + w / 4 AND col + 0.5 < x + w / 2 AND "row" + 0.5 > y + h / 4 AND "row" + 0.5 < y + h / 2) AS centre FROM b JOIN c ON "row" = r AND col = k)
"""
_UNIT: Z.Grid = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)


def _zones(read):
    """Every supplier, ten to a band of ten rows, so that zones reach as far down as events do."""
    k = F.col("s_suppkey")
    return read("supplier").select(k.alias("id"), _shape(k % 10 * 10 + F.lit(0.3), F.floor(k / 10) * 10 + F.lit(0.25), F.lit(7.0), F.lit(4.0)).alias("parts"), k.cast("double").alias("v"))


def _cells(read):
    return _grid(read).select("row", "col", "value")


@query(_CELLS + 'SELECT id, "row", col, round(overlap, 9) AS overlap FROM m WHERE overlap > 1e-12')
def cell_intersection_area(read):
    return Z.touch_join(_cells(read), _zones(read), _UNIT, "id", 8.0).select("id", "row", "col", F.round("overlap", 9).alias("overlap"))


@query(_CELLS + 'SELECT id, count(*) AS cells, round(avg(value), 8) AS mean, round(median(value), 8) AS median FROM m WHERE centre GROUP BY 1')
def zone_pixel_join(read):
    pairs = Z.centre_join(_cells(read), _zones(read), _UNIT, "id", 8.0)
    return pairs.groupBy("id").agg(F.count("*").alias("cells"), F.round(F.avg("value"), 8).alias("mean"), F.round(F.median("value"), 8).alias("median"))


@query(_CELLS + 'SELECT c."row", c.col, max(CAST(m.id AS DOUBLE)) AS v FROM c LEFT JOIN m ON c."row" = m."row" AND c.col = m.col AND m.overlap > 1e-12 GROUP BY 1, 2')
def rasterize_burn(read):
    return Z.burn(_cells(read), _zones(read), _UNIT, "v", "id", True, 8.0)


@query(_CELLS + 'SELECT DISTINCT c."row", c.col, c.value FROM c JOIN m ON c."row" = m."row" AND c.col = m.col WHERE m.centre')
def clip_centre(read):
    return Z.clip(_cells(read), _zones(read), _UNIT, "id", False, 8.0)


@query("""
WITH d AS (SELECT date, least(100.0, sum(w)) AS cov FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_custkey % 10 AS k, 10.0 AS w FROM orders GROUP BY 1, 2) GROUP BY 1)
SELECT date, CAST(cov AS DOUBLE) AS coverage_pct FROM d""")
def footprint_coverage(read):
    x = F.col("k") * 10
    wkt = F.format_string("geography'SRID=4326;POLYGON((%d 0, %d 0, %d 50, %d 50, %d 0))'", x, x + 10, x + 10, x, x)
    rows = read("orders").select(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 10).alias("k")).distinct().select("date", G.parse_footprint(wkt).alias("parts"))
    aoi = rows.sparkSession.range(1).select(G.parse_geojson(F.lit('{"type":"Polygon","coordinates":[[[0,0],[100,0],[100,40],[0,40],[0,0]]]}')).alias("parts"))
    return _round(G.coverage(rows, aoi, ["date"]), 6, "coverage_pct")


_N = (1 / 298.257223563) / (2 - 1 / 298.257223563)


@query(f"""
WITH k AS (SELECT p_partkey, -91.5::DOUBLE + p_partkey % 100 * 0.01::DOUBLE AS lon, 13.9::DOUBLE + p_partkey % 77 * 0.005::DOUBLE AS lat, {_N!r}::DOUBLE AS n FROM part),
c AS (SELECT *, 2 * sqrt(n) / (1 + n) AS cc, sin(radians(lat)) AS s, radians(lon + 93.0::DOUBLE) AS lam, n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16 AS a1, 13 * n * n / 48 - 3 * n * n * n / 5 AS a2, 61 * n * n * n / 240 AS a3, 6378137.0::DOUBLE / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) AS big FROM k),
t AS (SELECT *, sinh(atanh(s) - cc * atanh(cc * s)) AS t FROM c), x AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t)
SELECT p_partkey, round(500000 + 0.9996::DOUBLE * big * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta)), 3) AS easting, round(0.9996::DOUBLE * big * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta)), 3) AS northing FROM x""")
def utm_forward(read):
    lon, lat = F.lit(-91.5) + F.col("p_partkey") % 100 * 0.01, F.lit(13.9) + F.col("p_partkey") % 77 * 0.005
    e, n = G.utm_forward(lon, lat, 32615)
    return read("part").select("p_partkey", F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


@query("""
SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 32600 ELSE 32700 END + floor((s_suppkey % 360) / 6) + 1 AS INT) AS epsg, CAST(CASE s_suppkey % 3 WHEN 0 THEN 4326 WHEN 1 THEN 32615 ELSE 4326 END AS INT) AS crs FROM supplier""")
def crs_rules(read):
    k = F.col("s_suppkey")
    x, y = F.when(k % 3 == 0, -90.5).when(k % 3 == 1, 500_000.0).otherwise(5e6), F.when(k % 3 == 0, 14.0).otherwise(1.5e6)
    return read("supplier").select("s_suppkey", S.utm_epsg(k % 360 - 180, F.when(k % 2 == 0, 10.0).otherwise(-10.0)).alias("epsg"), S.sniff_crs(x, y).alias("crs"))


@query("""
WITH u AS (SELECT 'l_discount' AS band, CASE WHEN l_discount <> 0 THEN l_discount END AS v FROM lineitem UNION ALL SELECT 'l_tax', CASE WHEN l_tax <> 0 THEN l_tax END FROM lineitem)
SELECT band, count(*) AS pixels, count(*) - count(v) AS nodata, round(100.0 * (count(*) - count(v)) / count(*), 6) AS nodata_pct FROM u GROUP BY GROUPING SETS ((band), ())""")
def nodata_pct(read):
    rows = read("lineitem").select(*[R.decode_nodata(F.col(c)).alias(c) for c in ("l_discount", "l_tax")])
    return _round(R.nodata_pct(rows, ["l_discount", "l_tax"]), 6, "nodata_pct")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN -32768.0 ELSE l_discount END AS value FROM lineitem")
def fix_nodata(read):
    return read("lineitem").select("l_orderkey", "l_linenumber", R.encode_nodata(F.col("l_discount")).cast("double").alias("value"))


@query("""
WITH u AS (SELECT 'l_discount' AS band, l_discount AS v FROM lineitem UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem)
SELECT band, round(avg(v), 8) AS mean, round(stddev_pop(v), 8) AS sd, round(quantile_cont(v, 0.01), 8) AS p1, round(quantile_cont(v, 0.99), 8) AS p99 FROM u GROUP BY 1""")
def band_stats(read):
    return _round(R.band_stats(read("lineitem"), ["l_discount", "l_quantity"]), 8, "mean", "sd", "p1", "p99")


@query("""
WITH g AS (SELECT event_id // 100 AS r, event_id % 100 AS c, CASE WHEN event_type <> 'error' THEN value END AS v FROM events), t AS (SELECT r // 2 AS "row", c // 2 AS col, (c // 2 + 0.5) * 2.0 - 0.5 - 0.5 AS u, (r // 2 + 0.5) * 2.0 - 0.5 - 0.5 AS w FROM g WHERE r % 2 = 0 AND c % 2 = 0),
k AS (SELECT "row", col, floor(w) + i AS r, floor(u) + j AS c, (1 - abs(w - floor(w) - i)) * (1 - abs(u - floor(u) - j)) AS wt FROM t, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j))
SELECT k."row", k.col, round(sum(wt * v) / nullif(sum(wt) FILTER (v IS NOT NULL), 0), 6) AS value FROM k LEFT JOIN g ON k.r = g.r AND k.c = g.c WHERE wt > 0 GROUP BY 1, 2""")
def resample_bilinear(read):
    g = _grid(read).select("row", "col", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    target = g.where("row % 2 = 0 AND col % 2 = 0").select((F.col("row") / 2).cast("long").alias("row"), (F.col("col") / 2).cast("long").alias("col"))
    return _round(R.resample(g, _UNIT, target, (2.0, 0.0, -0.5, 0.0, 2.0, -0.5)), 6, "value")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(trunc(least(greatest(l_extendedprice - 20000, 0), 32767)) AS SMALLINT) END AS v FROM lineitem""")
def clip_cast(read):
    v = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_extendedprice") - 20000)
    return read("lineitem").select("l_orderkey", "l_linenumber", S.clip_cast(v, "smallint").alias("v"))


@query("""SELECT n_name AS zafra FROM nation WHERE n_regionkey = 1 ORDER BY 1""")
def active_seasons(read):
    rows = read("nation").select(F.col("n_name").alias("zafra"), F.lit("Some_Mill").alias("ingenio"), (F.col("n_regionkey") == 1).alias("temporada_activa"))
    return Y.active_seasons(rows, "some mill")


@query("""SELECT count(*) AS "rows", count(DISTINCT o_custkey) AS ids, count(*) - count(DISTINCT o_custkey) AS repeats FROM orders""")
def duplicate_ids(read):
    return Y.duplicate_ids(read("orders"), "o_custkey")


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_partkey % 5 = 0)")
def dates_to_fetch(read):
    have = read("lineitem").where("l_partkey % 5 = 0").select(F.to_date("l_shipdate").alias("date"))
    return T.missing(read("orders").select(F.to_date("o_orderdate").alias("date")).distinct(), have, ["date"])


@query("SELECT d AS date, CAST(row_number() OVER (ORDER BY d DESC) - 1 AS INT) AS slot, CASE WHEN row_number() OVER (ORDER BY d DESC) = 1 THEN 'inference' ELSE 'prev' || lpad(CAST(row_number() OVER (ORDER BY d DESC) - 1 AS VARCHAR), 2, '0') END AS role FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders ORDER BY 1 DESC LIMIT 6)")
def pair_slots(read):
    return T.slots(read("orders").select(F.to_date("o_orderdate").alias("date")))


@query("""SELECT o_custkey, d AS scene_date, CAST(n AS INT) AS slot FROM (SELECT o_custkey, d, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC) AS n FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1997-01-01')) WHERE n <= 5""")
def previous_dates(read):
    return T.previous_dates(read("orders").select("o_custkey", F.to_date("o_orderdate").alias("scene_date")), F.lit("1997-01-01").cast("date"), ["o_custkey"])


@query("""SELECT s_suppkey, CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h ' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' WHEN s >= 60 THEN CAST(s // 60 AS VARCHAR) || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE CAST(s AS VARCHAR) || 's' END AS elapsed FROM (SELECT s_suppkey, s_suppkey * 37 AS s FROM supplier)""")
def elapsed_text(read):
    return read("supplier").select("s_suppkey", S.elapsed(F.col("s_suppkey") * 37).alias("elapsed"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 2026.0::DOUBLE END AS zafra, CAST(CASE WHEN event_id % 5 <> 0 THEN event_id END AS DOUBLE) AS edad, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 11 AS BIGINT) END AS company_id FROM events WHERE event_id % 13 <> 0""")
def published_types(read):
    k = F.col("event_id")
    rows = read("events").select("event_id", F.when(k % 3 == 0, "2026").alias("zafra"), F.when(k % 5 != 0, k.cast("string")).alias("edad"), F.when(k % 13 == 0, "1.5").when(k % 7 != 0, F.concat((k % 11).cast("string"), F.lit(".0"))).alias("company_id"))
    return P.published_types(rows, "data_ndvi")[0]


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 AND l_tax = 0 THEN NULL ELSE round(coalesce(CASE WHEN l_linenumber > 1 THEN l_discount END, 0) + coalesce(CASE WHEN l_tax > 0 THEN l_tax END, 0), 8) END AS cosechado FROM lineitem""")
def harvested_sum(read):
    a, b = F.when(F.col("l_linenumber") > 1, F.col("l_discount")), F.when(F.col("l_tax") > 0, F.col("l_tax"))
    return read("lineitem").select("l_orderkey", "l_linenumber", F.round(Z.sum_with_any([a, b]), 8).alias("cosechado"))


@query("""SELECT s_suppkey, list_filter([CASE WHEN s_suppkey % 4 = 0 THEN 'band_mismatch' END, CASE WHEN s_suppkey % 200 = 0 THEN 'mostly_empty' END, CASE WHEN s_suppkey % 5 = 0 THEN 'no_crs' END, CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 3 = 0 THEN 'crs_mismatch' END, CASE WHEN s_suppkey % 7 = 0 THEN 'resolution_below_metre' END], lambda x: x IS NOT NULL)::VARCHAR AS issues FROM supplier""")
def raster_validation(read):
    k = F.col("s_suppkey")
    rows = read("supplier").select("s_suppkey", F.when(k % 4 == 0, 3).otherwise(15).alias("bands"), F.when(k % 5 == 0, None).when(k % 3 == 0, 32616).otherwise(32615).alias("crs"), F.when(k % 200 == 0, 0.001).otherwise(0.9).alias("nonzero_ratio"), F.when(k % 7 == 0, 0.5).otherwise(10.0).alias("pixel_width"), F.lit(True).alias("is_projected"))
    out = R.raster_issues(rows, 32615, 15)
    return out.select("s_suppkey", F.concat(F.lit("["), F.concat_ws(", ", "issues"), F.lit("]")).alias("issues"))


@query()
def vegetation_forest(read):
    """Radar-assisted fill: forests learn two bands from radar features of clear cells, and predict the cloud cells."""
    from verdance.operators import cloud

    g = read("events").select(F.floor(F.col("event_id") / 50).cast("int").alias("row"), (F.col("event_id") % 50).cast("int").alias("col"), F.col("value").alias("v"), (F.col("event_type") == "error").alias("c"))
    target = g.select("row", "col", F.when(F.col("c"), 9).otherwise(4).alias("SCL"), (F.col("v") * 10).alias("B04"), (F.col("v") * 20 + 5).alias("B08"))
    previous = g.select(F.lit("2024-01-01").cast("date").alias("scene_date"), F.lit(5).alias("days"), "row", "col", F.when(F.col("c") | (F.col("col") % 7 == 0), 9).otherwise(4).alias("SCL"), (F.col("v") * 10).alias("B04"), (F.col("v") * 20 + 5).alias("B08"))
    radar = g.select(F.lit(None).cast("date").alias("scene_date"), "row", "col", (F.col("v") + 1).alias("VV"), (F.col("v") * 2 + 1).alias("VH"))
    radar = radar.unionByName(radar.withColumn("scene_date", F.lit("2024-01-01").cast("date")))
    return cloud.remove_clouds(target, previous, radar, ["B04", "B08"]).select("row", "col", "source", "B04", "B08")


@query("SELECT CAST(year(o_orderdate) AS INT) AS zafra, count(*) AS n FROM orders GROUP BY 1")
def season_counts(read):
    return read("orders").groupBy(F.year("o_orderdate").alias("zafra")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def mill_filter(read):
    return read("customer").where(S.normalized_name(F.concat(F.lit("Mill_"), "c_mktsegment")) == S.normalized_name(F.lit("mill building"))).select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' - 42 AND DATE '1997-03-13'")
def lookback_window(read):
    return read("orders").where(T.lookback(F.to_date("o_orderdate"), F.lit("1997-03-01").cast("date"), 30, 12)).select("o_orderkey")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) + i AS day FROM orders, generate_series(0, 4) a(i)".replace("+ i", "+ CAST(i AS INT)"))
def inference_window(read):
    d = F.to_date("o_orderdate")
    return read("orders").select("o_orderkey", F.explode(T.inference_window(d, F.date_add(d, 2))).alias("day"))


_FILES = "SELECT event_id, user_id AS g, CASE WHEN event_type = 'error' THEN 'd/s2_filled.tif' ELSE 'd/x' || CAST(event_id AS VARCHAR) || '.tif' END AS path, CAST(event_id % 3000 AS BIGINT) AS length FROM events"


def _files(read):
    path = F.when(F.col("event_type") == "error", "d/s2_filled.tif").otherwise(F.concat(F.lit("d/x"), F.col("event_id").cast("string"), F.lit(".tif")))
    return read("events").select("event_id", F.col("user_id").alias("g"), path.alias("path"), (F.col("event_id") % 3000).alias("length"), F.col("event_id").alias("modificationTime"), "event_type")


@query(f"""WITH f AS ({_FILES}), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY CASE WHEN path LIKE '%s2_filled.tif' THEN 0 ELSE 1 END, length DESC, event_id DESC, path) AS n FROM f WHERE length >= 1000 OR path LIKE '%s2_filled.tif') SELECT g, path, length FROM r WHERE n = 1""")
def pick_file(read):
    return N.pick_file(_files(read), ["g"], ["s2_filled.tif"]).select("g", "path", "length")


@query(f"""WITH f AS (SELECT *, event_id % 2 = 0 AS s2 FROM ({_FILES})), b AS (SELECT g, max(length) FILTER (s2 AND length >= 1000) AS l2, max(length) FILTER (NOT s2 AND length >= 1000) AS l1 FROM f GROUP BY 1) SELECT CAST(g AS VARCHAR) AS role, l2 IS NOT NULL AS s2_exists, l1 IS NOT NULL AS s1_exists FROM b""")
def match_pairs(read):
    f = _files(read).select("path", "length", F.col("g").cast("string").alias("role"), F.lit(None).cast("date").alias("scene_date"), F.when(F.col("event_id") % 2 == 0, "s2").otherwise("s1").alias("kind"))
    return N.match_pairs(f).select("role", "s2_exists", "s1_exists")


@query("SELECT count(*) AS pairs, count(*) FILTER (event_id % 3 <> 0 AND event_id % 5 <> 0) AS valid, 100.0::DOUBLE * count(*) FILTER (event_id % 3 <> 0 AND event_id % 5 <> 0) / count(*) AS success_pct FROM events")
def pair_summary(read):
    return N.pair_summary(read("events").select((F.col("event_id") % 3 != 0).alias("s2_exists"), (F.col("event_id") % 5 != 0).alias("s1_exists")))


@query("SELECT l_suppkey, min(l_discount) AS \"min\", max(l_discount) AS \"max\", round(avg(l_discount), 8) AS mean, round(count(*) FILTER (l_discount <> 0) / count(*), 8) AS nonzero_ratio FROM lineitem GROUP BY 1")
def index_report(read):
    return _round(R.index_report(read("lineitem"), "l_discount", ["l_suppkey"]), 8, "mean", "nonzero_ratio")


@query(f'SELECT "row", col, CAST(NULL AS DOUBLE) AS ndvi FROM {GRID}')
def blank_raster(read):
    return R.blank(_grid(read), ["ndvi"])


@query(f"""SELECT "row", col, CASE WHEN event_type = 'view' THEN value ELSE 0 END AS "VV", CASE WHEN event_type = 'view' THEN value * 2 ELSE 0 END AS "VH", event_type = 'view' AND value <> 0 AND abs(value) < 1e6 AND abs(value * 2) < 1e6 AS valid FROM {GRID}""")
def radar_zero_fill(read):
    g = _grid(read)
    radar = g.where("event_type = 'view'").select("row", "col", F.col("value").alias("VV"), (F.col("value") * 2).alias("VH"))
    out = R.radar_or_zero(g.select("row", "col"), radar)
    return out.withColumn("valid", S.radar_valid(F.col("VV"), F.col("VH")))


@query("SELECT user_id, round(CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN count(*) FILTER (event_type = 'error' AND event_id % 2 = 0) * 100.0 / count(*) FILTER (event_type = 'error') ELSE 0 END, 6) AS filled_pct FROM events GROUP BY 1")
def fill_percent(read):
    error = F.col("event_type") == "error"
    g = read("events").groupBy("user_id").agg(F.count_if(error).cast("double").alias("c"), F.count_if(error & (F.col("event_id") % 2 == 0)).cast("double").alias("f"))
    return g.select("user_id", F.round(S.filled_percent(F.col("f"), F.col("c")), 6).alias("filled_pct"))


@query("SELECT CAST(event_id // 100 // 16 AS INT) AS tile_r, CAST(event_id % 100 // 16 AS INT) AS tile_c, count(*) AS n FROM events GROUP BY 1, 2")
def tile_keys(read):
    return R.tile_keys(_grid(read), 16).groupBy("tile_r", "tile_c").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, 'GT_CO_DATA_' || o_orderstatus || '_Mill_A_' || strftime(CAST(o_orderdate AS DATE), '%Y_%m_%d') || '.parquet' AS name FROM orders")
def product_file_name(read):
    return read("orders").select("o_orderkey", S.file_name(F.lit("GT"), F.lit("CO"), F.col("o_orderstatus"), F.lit("Mill_A"), F.to_date("o_orderdate")).alias("name"))


@query("""SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","day":' || CASE WHEN n_regionkey = 1 THEN 'null' ELSE '"2024-01-05"' END || '}' AS record FROM nation""")
def row_records(read):
    return P.records(read("nation").select("n_nationkey", "n_name", F.when(F.col("n_regionkey") != 1, F.lit("2024-01-05").cast("date")).alias("day")))


@query("SELECT date, tile_id, min(product_name) AS product_name FROM (SELECT CAST(o_orderdate AS DATE) AS date, 'T' || CAST(o_custkey % 3 AS VARCHAR) AS tile_id, 'S2_' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS product_name FROM orders) GROUP BY 1, 2")
def catalogue_dedupe(read):
    rows = read("orders").select(F.to_date("o_orderdate").alias("date"), F.concat(F.lit("T"), (F.col("o_custkey") % 3).cast("string")).alias("tile_id"), F.concat(F.lit("S2_"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0")).alias("product_name"))
    return N.dedupe_catalogue(rows)


@query(_CELLS.split("c AS (")[0].rstrip().rstrip(",") + " SELECT id FROM z WHERE x <= 30 AND x + w >= 12 AND y + h >= 2")
def zone_box_filter(read):
    return Z.box_filter(_zones(read), 12.0, 2.0, 30.0, float("inf")).select("id")


@query("""
WITH x AS (SELECT event_id, value AS o, CASE WHEN event_id % 6 <> 0 THEN value * 2 END AS f, CASE event_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.25 WHEN 2 THEN 0.0 END AS w FROM events)
SELECT event_id, round(CASE WHEN coalesce(w, 0) = 0 OR f IS NULL THEN o WHEN w >= 1 OR o IS NULL THEN f ELSE o * (1 - w) + f * w END, 8) AS value FROM x""")
def blend_values(read):
    k = F.col("event_id") % 4
    w = F.when(k == 0, 1.0).when(k == 1, 0.25).when(k == 2, 0.0)
    return read("events").select("event_id", F.round(R.blend(F.col("value"), F.when(F.col("event_id") % 6 != 0, F.col("value") * 2), w), 8).alias("value"))


@query(f"""
WITH z AS (SELECT l_suppkey AS zone, avg(l_discount) AS pot FROM lineitem GROUP BY 1), r AS (SELECT l_orderkey, l_linenumber, CASE WHEN pot = 0 THEN 0 ELSE l_discount / pot END AS q FROM lineitem JOIN z ON l_suppkey = zone)
SELECT l_orderkey, l_linenumber, CASE WHEN round(q, 9) < 0.6 THEN 1 WHEN round(q, 9) < 0.9 THEN 2 WHEN round(q, 9) < 1.1 THEN 3 WHEN round(q, 9) < 1.3 THEN 4 ELSE 5 END AS k FROM r""")
def potential_ratio_class(read):
    li = read("lineitem")
    pot = li.groupBy("l_suppkey").agg(F.avg("l_discount").alias("pot"))
    q = F.round(S.raster_math(F.col("l_discount"), F.col("pot"), "divide"), 9)
    return li.join(pot, "l_suppkey").select("l_orderkey", "l_linenumber", S.reclassify(q, K.POTENTIAL_CLASSES).alias("k"))


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'data_ndvi' WHEN 1 THEN 'data_ndwi' WHEN 2 THEN 'data_sg' ELSE 'data_maleza' END AS table_name, round((s_suppkey % 9 + 1) * 111.0::DOUBLE * 0.5 * 111, 6) AS km2 FROM supplier")
def product_tables(read):
    k = F.col("s_suppkey")
    name = F.element_at(F.array(*[F.lit(f"x_{p}_y.parquet") for p in K.PRODUCTS]), (k % 4 + 1).cast("int"))
    return read("supplier").select("s_suppkey", S.published_table(name).alias("table_name"), F.round(S.bbox_km2(F.lit(-91.0), F.lit(14.0), F.lit(-91.0) + k % 9 + 1, F.lit(14.5)), 6).alias("km2"))


@query("SELECT o_orderkey, CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), DATE '1996-01-01')) AS INT) AS days FROM orders")
def days_between(read):
    return read("orders").select("o_orderkey", S.days_between(F.to_date("o_orderdate"), F.lit("1996-01-01").cast("date")).alias("days"))


@query("SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_tax <> 0 AND l_linenumber <> 2 AND l_returnflag <> 'R'")
def complete_rows(read):
    """Without rows that hold a null or NaN anywhere."""
    rows = read("lineitem").select(F.col("l_orderkey").alias("k"), F.when(F.col("l_linenumber") != 2, F.col("l_linenumber")).alias("n"), F.when(F.col("l_tax") == 0, float("nan")).otherwise(F.col("l_tax")).alias("t"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("f"))
    return P.complete_rows(rows).select("k", "n")


@query("SELECT o_orderkey AS id_parcela FROM orders WHERE o_orderstatus = 'P'")
def missing_starts(read):
    rows = read("orders").select(F.col("o_orderkey").alias("id_parcela"), F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("fecha_inicio"))
    return P.missing_starts(rows)
