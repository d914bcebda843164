"""Raster operators on pixel tables: one row a cell, one column a band, nodata as null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.functions import scalar as S
from verdance.functions import tables as K

CELL = ["row", "col"]


def tile_keys(pixels: DataFrame, size: int = 1024) -> DataFrame:
    """Keys of the square tile that a cell lies in; the unit of partitioning."""
    return pixels.withColumns({"tile_r": F.floor(F.col("row") / size).cast("int"), "tile_c": F.floor(F.col("col") / size).cast("int")})


def decode_nodata(value: Column, header: float | None = None) -> Column:
    """Null where the value is nodata: the header's code, else NaN, 0 and -9999."""
    if header is not None:
        return F.when(F.isnan(value) | (value == header), None).otherwise(value)
    return F.when(F.isnan(value) | (value == 0) | (value == -9999), None).otherwise(value)


def encode_nodata(value: Column, code: float = K.INDEX_NODATA, zero_too: bool = True) -> Column:
    """The code where the value is null or NaN, and where it is exactly 0 if zero_too."""
    bad = value.isNull() | F.isnan(value)
    return F.when(bad | (value == 0) if zero_too else bad, F.lit(code)).otherwise(value)


def calculate(first: DataFrame, second: DataFrame, operation: str, keys: list[str] | None = None, value: str = "value") -> DataFrame:
    """Cell by cell divide, multiply, add or subtract; null where either side is, on the grid of both."""
    keys = keys or CELL
    a, b = first.select(*keys, F.col(value).alias("__a")), second.select(*keys, F.col(value).alias("__b"))
    return a.join(b, keys, "full").select(*keys, S.raster_math(F.col("__a"), F.col("__b"), operation).alias(value))


def cloud_mask(pixels: DataFrame, buffer: int = 5, classes: list[int] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Cells with `cloud`, and `buffered`: within `buffer` steps (4-connected) of a cloud cell.

    Each cloud cell emits the diamond around it: a fixed number of rows, joined by cell.
    """
    keys = keys or []
    cells = pixels.withColumn("cloud", F.coalesce(F.col("SCL").isin(classes or K.CLOUD_CLASSES), F.lit(False)))
    if not buffer:
        return cells.withColumn("buffered", F.col("cloud"))
    near = diamond(cells.where("cloud"), buffer, keys).groupBy(*keys, *CELL).agg(F.lit(True).alias("__near"))
    return cells.join(near, [*keys, *CELL], "left").withColumn("buffered", F.coalesce("__near", F.lit(False))).drop("__near")


def diamond(cells: DataFrame, radius: int, keys: list[str]) -> DataFrame:
    """The cells within `radius` steps of each given cell, with the number of steps."""
    offsets = [(r, c) for r in range(-radius, radius + 1) for c in range(-radius, radius + 1) if abs(r) + abs(c) <= radius]
    around = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in offsets])
    out = cells.select(*keys, "row", "col", F.explode(around).alias("o"))
    return out.select(*keys, (F.col("row") + F.col("o.r")).alias("row"), (F.col("col") + F.col("o.c")).alias("col"), (F.abs("o.r") + F.abs("o.c")).alias("steps"))


def blend_weights(mask: DataFrame, radius: int = 5, keys: list[str] | None = None) -> DataFrame:
    """cell, weight: 1 on the mask's cells, 1 - distance / radius around them (Euclidean, not below 0)."""
    keys = keys or []
    offsets = [(r, c) for r in range(-radius, radius + 1) for c in range(-radius, radius + 1) if r * r + c * c < radius * radius]
    around = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), F.lit(max(0.0, 1 - (r * r + c * c) ** 0.5 / radius)).alias("w")) for r, c in offsets])
    near = mask.where("cloud").select(*keys, "row", "col", F.explode(around).alias("o"))
    return near.groupBy(*keys, (F.col("row") + F.col("o.r")).alias("row"), (F.col("col") + F.col("o.c")).alias("col")).agg(F.max("o.w").alias("weight"))


def blend(original: Column, filled: Column, weight: Column) -> Column:
    """original (1 - w) + filled w; the original where there is nothing to blend."""
    w = F.coalesce(weight, F.lit(0.0))
    return F.when((w == 0) | filled.isNull(), original).when((w >= 1) | original.isNull(), filled).otherwise(original * (1 - w) + filled * w)


def temporal_fill(previous: DataFrame, bands: list[str], keys: list[str] | None = None, most: float = 500.0) -> DataFrame:
    """Each band at the target's date, from earlier scenes: (keys, days, cloud, bands).

    Weights are 1 / days for clear cells. One clear scene gives its value; more give the
    weighted line at 0 days, its slope within +-most, not below 0; no spread of days
    gives the weighted mean. All bands in one aggregation. Null without a clear scene.
    """
    keys = keys or CELL
    x = F.col("days").cast("double")
    sums = []
    for b in bands:
        v = F.col(b).cast("double")
        w = F.when(~F.col("cloud") & v.isNotNull(), 1 / F.greatest(x, F.lit(1.0)))
        sums += [F.count(w).alias(f"{b}__n"), F.sum(w).alias(f"{b}__w"), F.sum(w * x).alias(f"{b}__x"), F.sum(w * v).alias(f"{b}__y"), F.sum(w * x * x).alias(f"{b}__xx"), F.sum(w * x * v).alias(f"{b}__xy")]
    got = previous.groupBy(*keys).agg(*sums)

    def value(b: str) -> Column:
        n, w, sx, sy, sxx, sxy = (F.col(f"{b}__{k}") for k in ("n", "w", "x", "y", "xx", "xy"))
        den = w * sxx - sx * sx
        mean = sy / F.greatest(w, F.lit(1e-10))
        slope = F.greatest(F.lit(-most), F.least(F.lit(most), (w * sxy - sx * sy) / F.when(F.abs(den) > 1e-10, den)))
        line = F.when(F.abs(den) > 1e-10, (sy - slope * sx) / F.when(w != 0, w)).otherwise(mean)
        return F.when(n == 1, mean).when(n > 1, F.greatest(line, F.lit(0.0))).alias(b)

    return got.select(*keys, *map(value, bands))


def nearest_fill(cells: DataFrame, value: str = "value", radius: int = 50, keys: list[str] | None = None) -> DataFrame:
    """Cells with nulls filled from the nearest valid cell within `radius` (Euclidean); ties to the smaller row, then column.

    Cells fall into blocks of the radius; a null cell meets the valid cells of the nine
    blocks around it through an equi-join, and one aggregation keeps the nearest. Reaches
    grow: 5, 15, then the radius, each only for cells with nothing valid in the one
    before, as what is nearest there is nearest of all.
    """
    keys = keys or []
    step = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    empty = cells.where(F.col(value).isNull()).select(*keys, "row", "col")
    d2 = (F.col("row") - F.col("r2")) * (F.col("row") - F.col("r2")) + (F.col("col") - F.col("c2")) * (F.col("col") - F.col("c2"))

    def nearest(want: DataFrame, reach: int) -> DataFrame:
        block = lambda c: F.floor(F.col(c) / reach)
        want = want.withColumn("dr", step).withColumn("dc", step)
        want = want.withColumns({"__r": block("row") + F.col("dr"), "__c": block("col") + F.col("dc")})
        have = cells.where(F.col(value).isNotNull()).select(*keys, F.col("row").alias("r2"), F.col("col").alias("c2"), F.col(value).alias("__v")).withColumns({"__r": block("r2"), "__c": block("c2")})
        return want.join(have, [*keys, "__r", "__c"]).where(d2 <= reach * reach).groupBy(*keys, "row", "col").agg(F.min_by("__v", F.struct(d2, "r2", "c2")).alias("__fill"))

    best = nearest(empty, min(radius, 5))
    for reach in [r for r in (15, radius) if 5 < r <= radius]:
        best = best.unionByName(nearest(empty.join(best, [*keys, "row", "col"], "left_anti"), reach))
    return cells.join(best, [*keys, "row", "col"], "left").withColumn(value, F.coalesce(value, "__fill")).drop("__fill")


def focal_sums(cells: DataFrame, columns: dict[str, Column], radii: list[int], keys: list[str] | None = None) -> DataFrame:
    """keys, row, col and, for each column and radius, its sum over the square around (<name>__<radius>); borders mirrored with the edge cell repeated.

    Sums go along the rows, then along the columns: two sliding windows for all columns
    and radii together. A window's partition is one row or column of one raster.
    """
    keys, most = keys or [], max(radii)
    size = cells.groupBy(*keys).agg(F.max("row").alias("__h"), F.max("col").alias("__w"))
    out = cells.select(*keys, "row", "col", *[c.alias(f"{n}__{r}") for n, c in columns.items() for r in radii])
    # one row for each raster; a single raster is one row
    out = out.join(size, keys) if keys else out.crossJoin(F.broadcast(size))
    for along, across, top in (("col", "row", "__w"), ("row", "col", "__h")):
        # where a cell stands along the axis: itself, and before and after the border
        both = F.filter(F.array(F.col(along), -1 - F.col(along), 2 * F.col(top) + 1 - F.col(along)), lambda p: (p >= -most) & (p <= F.col(top) + most))
        out = out.withColumn(along, F.explode(both))
        w = Window.partitionBy(*keys, across).orderBy(along)
        sums = {f"{n}__{r}": F.sum(f"{n}__{r}").over(w.rangeBetween(-r, r)) for n in columns for r in radii}
        out = out.withColumns(sums).where(F.col(along).between(0, F.col(top)))
    return out.drop("__h", "__w")


def focal(cells: DataFrame, radius: int, value: str = "value", keys: list[str] | None = None) -> DataFrame:
    """mean and variance of a dense grid over the square of `radius`, borders mirrored."""
    keys, n = keys or [], float((2 * radius + 1) ** 2)
    v = F.col(value).cast("double")
    out = focal_sums(cells, {"a": v, "b": v * v}, [radius], keys)
    mean = F.col(f"a__{radius}") / n
    return out.select(*keys, "row", "col", mean.alias("mean"), F.greatest(F.lit(0.0), F.col(f"b__{radius}") / n - mean * mean).alias("variance"))


def radar_features(radar: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Fourteen features of each valid radar cell (VV, VH): ratios, logs, focal means and deviations, contrast."""
    keys = keys or []
    floor = lambda c: F.greatest(F.abs(c), F.lit(1e-10))
    vv, vh = F.coalesce(F.col("VV").cast("double"), F.lit(0.0)), F.coalesce(F.col("VH").cast("double"), F.lit(0.0))
    base = radar.select(*keys, "row", "col", vv.alias("vv"), vh.alias("vh"), S.radar_valid(F.col("VV"), F.col("VH")).alias("valid"))
    out = base.withColumns({
        "vv_vh": F.col("vv") / floor(F.col("vh")), "vh_vv": F.col("vh") / floor(F.col("vv")), "product": F.col("vv") * F.col("vh"),
        "log_vv": F.log10(floor(F.col("vv"))), "log_vh": F.log10(floor(F.col("vh"))),
        "contrast": (F.col("vv") - F.col("vh")) / F.greatest(F.abs("vv") + F.abs("vh"), F.lit(1e-10))})
    sums = focal_sums(base, {"vv": F.col("vv"), "vh": F.col("vh"), "vv2": F.col("vv") * F.col("vv"), "vh2": F.col("vh") * F.col("vh")}, [1, 2, 3], keys)
    around = []
    for band in ("vv", "vh"):
        around += [(F.col(f"{band}__{r}") / float((2 * r + 1) ** 2)).alias(f"{band}_mean{2 * r + 1}") for r in (1, 3)]
        mean = F.col(f"{band}__2") / 25.0
        around.append(F.sqrt(F.greatest(F.lit(0.0), F.col(f"{band}2__2") / 25.0 - mean * mean)).alias(f"{band}_sd5"))
    out = out.join(sums.select(*keys, "row", "col", *around), [*keys, "row", "col"], "left")
    features = ["vv", "vh", "vv_vh", "vh_vv", "product", "log_vv", "log_vh", "vv_mean3", "vh_mean3", "vv_mean7", "vh_mean7", "vv_sd5", "vh_sd5", "contrast"]
    return out.select(*keys, "row", "col", "valid", *[F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0)).alias(c) for c in features])


def resample(source: DataFrame, source_grid: tuple[float, float, float, float, float, float], target: DataFrame, target_grid: tuple[float, float, float, float, float, float], value: str = "value") -> DataFrame:
    """Bilinear resampling onto the target's cells; grids are affine (a, b, c, d, e, f), x = a col + b row + c.

    Weights are renormalised over the valid neighbours; null if there is none.
    """
    a, b, c, d, e, f = source_grid
    det = a * e - b * d
    ta, tb, tc, td, te, tf = target_grid
    x = ta * (F.col("col") + 0.5) + tb * (F.col("row") + 0.5) + tc
    y = td * (F.col("col") + 0.5) + te * (F.col("row") + 0.5) + tf
    u = (e * (x - c) - b * (y - f)) / det - 0.5
    v = (a * (y - f) - d * (x - c)) / det - 0.5
    cells = target.select("row", "col", u.alias("u"), v.alias("v")).withColumns({"c0": F.floor("u").cast("int"), "r0": F.floor("v").cast("int")})
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    cells = cells.withColumn("k", corner).select("row", "col", (F.col("r0") + F.col("k.i")).alias("r"), (F.col("c0") + F.col("k.j")).alias("c"), ((1 - F.abs(F.col("v") - F.col("r0") - F.col("k.i"))) * (1 - F.abs(F.col("u") - F.col("c0") - F.col("k.j")))).alias("w"))
    own = source.select(F.col("row").alias("r"), F.col("col").alias("c"), F.col(value).alias("__v"))
    got = cells.join(own, ["r", "c"], "left").where("w > 0")
    w = F.when(F.col("__v").isNotNull(), F.col("w"))
    return got.groupBy("row", "col").agg((F.sum(F.col("w") * F.col("__v")) / F.nullif(F.sum(w), F.lit(0.0))).alias(value))


def median_composite(radar: DataFrame, date: Column, bands: list[str], days: int = 60, keys: list[str] | None = None) -> DataFrame:
    """Median of each band over the ascending passes of the days up to a date."""
    keys = keys or CELL
    window = F.col("scene_date").between(F.date_sub(date, days), date)
    if "orbit" in radar.columns:
        window &= F.lower("orbit") == "ascending"
    return radar.where(window).groupBy(*keys).agg(*[F.median(b).alias(b) for b in bands])


def cloud_stats(pixels: DataFrame, by: list[str], classes: list[int] | None = None) -> DataFrame:
    """total, cloud, clear and cloud_pct of each scene."""
    hit = F.col("SCL").isin(classes or K.CLOUD_CLASSES)
    return pixels.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(hit).alias("cloud"), (F.count("*") - F.count_if(hit)).alias("clear"), (100.0 * F.count_if(hit) / F.count("*")).alias("cloud_pct"))


def preview_stats(pixels: DataFrame, by: list[str]) -> DataFrame:
    """nodata, cloud and clear percentages of a coarse scene classification; complete if nodata stays under 10 %."""
    scl = F.col("SCL")
    nodata = scl.isNull() | scl.isin(K.PREVIEW_NODATA)
    pct = lambda c: 100.0 * F.count_if(c) / F.count("*")
    out = pixels.groupBy(*by).agg(pct(nodata).alias("nodata_pct"), pct(scl.isin(K.PREVIEW_CLOUD_CLASSES)).alias("cloud_pct"), pct(scl.isin(K.PREVIEW_CLEAR_CLASSES)).alias("valid_pct"))
    return out.withColumn("is_complete", F.col("nodata_pct") < 10)


def nodata_pct(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """band, pixels, nodata, nodata_pct by band, and of all together under a null band."""
    stacked = pixels.select(*bands).unpivot([], bands, "band", "value") if bands else pixels
    out = stacked.groupingSets([["band"], []], "band").agg(F.count("*").alias("pixels"), F.count_if(F.col("value").isNull()).alias("nodata"))
    return out.withColumn("nodata_pct", F.when(F.col("pixels") > 0, 100.0 * F.col("nodata") / F.col("pixels")))


def band_stats(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """mean, sd, p1, p99 of each band, by exact interpolated percentiles."""
    return pixels.select(*bands).unpivot([], bands, "band", "value").groupBy("band").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"), F.percentile("value", 0.01).alias("p1"), F.percentile("value", 0.99).alias("p99"))


def raster_issues(stats: DataFrame, crs: int | None, bands: int | None) -> DataFrame:
    """An array of issue names for each raster, from (bands, crs, nonzero_ratio, pixel_width, is_projected)."""
    rules = {
        "band_mismatch": F.col("bands") != bands if bands else F.lit(False), "mostly_empty": F.col("nonzero_ratio") < 0.01, "no_crs": F.col("crs").isNull(),
        "crs_mismatch": F.col("crs") != crs if crs else F.lit(False), "degrees_in_projected": F.col("is_projected") & (F.abs("pixel_width") < 0.01), "resolution_below_metre": F.col("is_projected") & (F.abs("pixel_width") >= 0.01) & (F.abs("pixel_width") < 1)}
    return stats.withColumn("issues", F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()])))


def valid_file(size: Column, bands: Column, expected: int) -> Column:
    return (size >= 1000) & (bands == expected)


def radar_or_zero(cells: DataFrame, radar: DataFrame | None, keys: list[str] | None = None) -> DataFrame:
    """cells with VV and VH; 0, which no feature takes as valid, where there is no radar."""
    keys = keys or CELL
    if radar is None:
        return cells.withColumns({b: F.lit(0.0) for b in K.RADAR_BANDS})
    out = cells.join(radar.select(*keys, *K.RADAR_BANDS), keys, "left")
    return out.withColumns({b: F.coalesce(F.nanvl(F.col(b).cast("double"), F.lit(0.0)), F.lit(0.0)) for b in K.RADAR_BANDS})


def blank(cells: DataFrame, names: list[str]) -> DataFrame:
    """The same cells without a value: what a product without any eligible parcel writes."""
    return cells.select("row", "col", *[F.lit(None).cast("double").alias(n) for n in names])


def index_report(cells: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """min, max, mean of the valid cells, and the share of cells that are neither null nor 0."""
    v = F.col(value)
    return cells.groupBy(*(by or [])).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), (F.count_if(v != 0) / F.count("*")).alias("nonzero_ratio"))
