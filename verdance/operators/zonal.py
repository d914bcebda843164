"""Zones against pixels: spatial joins by tile keys, zonal statistics, class areas, burning.

Cells and zones meet through an equi-join on the square tiles that they cover, then an
exact test. Zones are never broadcast by force; Catalyst picks the join by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.sources.store import written

Grid = tuple[float, float, float, float, float, float]


_OWN = ("__tx", "__ty", "__zwest", "__zsouth", "__zeast", "__znorth", "__xs", "__ys", "__rings", "parts")


def cell_boxes(pixels: DataFrame, grid: Grid) -> DataFrame:
    """pixels with their centre (x, y) and box; grid is affine (a, b, c, d, e, f), without rotation for boxes."""
    a, b, c, d, e, f = grid
    x = lambda dc, dr: a * (F.col("col") + dc) + b * (F.col("row") + dr) + c
    y = lambda dc, dr: d * (F.col("col") + dc) + e * (F.col("row") + dr) + f
    corners = [(0, 0), (1, 0), (0, 1), (1, 1)]
    return pixels.withColumns({
        "x": x(0.5, 0.5), "y": y(0.5, 0.5), "west": F.least(*[x(*k) for k in corners]), "east": F.greatest(*[x(*k) for k in corners]),
        "south": F.least(*[y(*k) for k in corners]), "north": F.greatest(*[y(*k) for k in corners])})


def _tiles(df: DataFrame, tile: float, west: str, south: str, east: str, north: str) -> DataFrame:
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / tile), F.floor(F.col(b) / tile)))
    return df.withColumn("__tx", span(west, east)).withColumn("__ty", span(south, north))


def _zone_tiles(zones: DataFrame, zone_id: str, tile: float, extra: list[str]) -> DataFrame:
    box = G.bounds(F.col("parts"))
    flat = [c.alias(f"__{k}") for k, c in G.flat(F.col("parts")).items()]
    out = zones.where(F.col("parts").isNotNull()).select(F.col(zone_id), "parts", *flat, *extra, *[c.alias(f"__z{k}") for k, c in box.items()])
    return _tiles(out, tile, "__zwest", "__zsouth", "__zeast", "__znorth")


def centre_join(pixels: DataFrame, zones: DataFrame, grid: Grid, zone_id: str = "id_parcela", tile: float = 1000.0, extra: list[str] | None = None) -> DataFrame:
    """Pairs of a cell and a zone that holds the cell's centre."""
    cells = cell_boxes(pixels, grid).withColumns({"__tx": F.floor(F.col("x") / tile), "__ty": F.floor(F.col("y") / tile)})
    met = cells.join(_zone_tiles(zones, zone_id, tile, extra or []), ["__tx", "__ty"])
    in_box = F.col("x").between(F.col("__zwest"), F.col("__zeast")) & F.col("y").between(F.col("__zsouth"), F.col("__znorth"))
    return met.where(in_box & G.inside(F.col("x"), F.col("y"), F.col("parts"))).drop(*_OWN)


def touch_join(pixels: DataFrame, zones: DataFrame, grid: Grid, zone_id: str = "id_parcela", tile: float = 1000.0, extra: list[str] | None = None) -> DataFrame:
    """Pairs of a cell and a zone that share area, with that area (`overlap`)."""
    cells = _tiles(cell_boxes(pixels, grid), tile, "west", "south", "east", "north")
    met = cells.join(_zone_tiles(zones, zone_id, tile, extra or []), ["__tx", "__ty"])
    met = met.where((F.col("west") < F.col("__zeast")) & (F.col("east") > F.col("__zwest")) & (F.col("south") < F.col("__znorth")) & (F.col("north") > F.col("__zsouth")))
    # a pair that meets in several tiles counts in the first alone
    first = (F.col("__tx") == F.floor(F.greatest("west", "__zwest") / tile)) & (F.col("__ty") == F.floor(F.greatest("south", "__zsouth") / tile))
    met = met.where(first).withColumn("overlap", G.cell_area("__xs", "__ys", "__rings", "west", "south", "east", "north"))
    return met.where("overlap > 0").drop(*_OWN)


def zonal_stats(pairs: DataFrame, zone: str | list[str], value: str, prefix: str = "") -> DataFrame:
    """mean, stdv (population), min, max and exact median of the valid cells of each zone; zones without any are left out."""
    keys = [zone] if isinstance(zone, str) else zone
    v = F.when(~F.isnan(F.col(value)), F.col(value)) if dict(pairs.dtypes)[value] in ("double", "float") else F.col(value)
    return pairs.where(v.isNotNull()).groupBy(*keys).agg(F.avg(v).alias(f"{prefix}mean"), F.stddev_pop(v).alias(f"{prefix}stdv"), F.min(v).alias(f"{prefix}min"), F.max(v).alias(f"{prefix}max"), F.median(v).alias(f"{prefix}median"))


def class_area(pairs: DataFrame, zone: str, klass: str = "gridcode", area: str = "overlap", unit: float = 10_000.0) -> DataFrame:
    """Area in hectares of each class in each zone."""
    return pairs.where(F.col(klass).isNotNull()).groupBy(zone, klass).agg((F.sum(area) / unit).alias("area"))


def class_pivot(areas: DataFrame, zone: str, classes: list[int], prefix: str, klass: str = "gridcode", area: str = "area") -> DataFrame:
    """A column for each class; a class that a zone lacks is 0. The columns are fixed, whatever classes occur."""
    sums = [F.coalesce(F.sum(F.when(F.col(klass) == k, F.col(area))), F.lit(0.0)).alias(f"{prefix}{k}") for k in classes]
    return areas.groupBy(zone).agg(*sums)


def sum_with_any(columns: list[Column]) -> Column:
    """Row-wise sum that skips nulls; null if all are."""
    return F.when(F.coalesce(*columns).isNotNull(), sum((F.coalesce(c, F.lit(0.0)) for c in columns), F.lit(0.0)))


def burn(pixels: DataFrame, zones: DataFrame, grid: Grid, value: str, zone_id: str = "id_parcela", all_touched: bool = True, tile: float = 1000.0) -> DataFrame:
    """row, col, value: a zone's value on each cell; of several zones the largest id wins; null elsewhere."""
    join = touch_join if all_touched else centre_join
    hit = join(pixels.select("row", "col"), zones, grid, zone_id, tile, [value]).groupBy("row", "col").agg(F.max_by(value, zone_id).alias(value))
    return pixels.select("row", "col").join(hit, ["row", "col"], "left")


def clip(pixels: DataFrame, zones: DataFrame, grid: Grid, zone_id: str = "id_parcela", all_touched: bool = True, tile: float = 1000.0) -> DataFrame:
    """The cells that any zone touches, or holds the centre of."""
    join = touch_join if all_touched else centre_join
    hit = join(pixels.select("row", "col"), zones, grid, zone_id, tile).select("row", "col").distinct()
    return pixels.join(hit, ["row", "col"], "left_semi")


def box_filter(zones: DataFrame, west: float, south: float, east: float, north: float, exact: str | None = None) -> DataFrame:
    """Zones whose box meets a raster's; with the name of their id as `exact`, those that share area with it."""
    b = G.bounds(F.col("parts"))
    near = zones.where((b["west"] <= east) & (b["east"] >= west) & (b["south"] <= north) & (b["north"] >= south))
    if exact is None:
        return near
    flat = {f"__{k}": c for k, c in G.flat(F.col("parts")).items()}
    sides = {f"__b{i}": F.lit(float(x)) for i, x in enumerate((west, south, east, north))}
    # written, as shapes that are computed in the same plan don't reach Python below a filter
    shapes = written(near.select(exact, *[c.alias(k) for k, c in (flat | sides).items()]))
    hit = shapes.withColumn("__share", G.cell_area(*flat, *sides)).where("__share > 0").select(exact).distinct()
    return near.join(hit, exact, "left_semi")
