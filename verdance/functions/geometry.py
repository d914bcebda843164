"""Polygons as arrays of parts, parts as arrays of rings, rings as arrays of (x, y).

A part's first ring is its outline, others are holes; a point is inside a shape if it
is inside an odd number of its rings.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

POINT = "struct<x:double,y:double>"
RINGS = f"array<array<{POINT}>>"
PARTS = f"array<{RINGS}>"


def _points(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def parse_geojson(text: Column) -> Column:
    """Parts of a GeoJSON Polygon or MultiPolygon; null for anything else."""
    kind = F.try_parse_json(text)
    name = F.when(kind.isNotNull(), F.get_json_object(text, "$.type"))
    coordinates = F.get_json_object(text, "$.coordinates")
    one = F.array(F.transform(F.from_json(coordinates, "array<array<array<double>>>"), _points))
    many = F.transform(F.from_json(coordinates, "array<array<array<array<double>>>>"), lambda part: F.transform(part, _points))
    return F.when(name == "Polygon", one).when(name == "MultiPolygon", many)


def parse_wkt(text: Column) -> Column:
    """Parts of a WKT POLYGON or MULTIPOLYGON; null for anything else."""
    ring = lambda s: F.transform(F.split(s, ","), lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].try_cast("double").alias("x"), F.try_element_at(F.split(F.trim(p), r"\s+"), F.lit(2)).try_cast("double").alias("y")))
    rings = lambda s: F.transform(F.regexp_extract_all(s, F.lit(r"\(([^()]+)\)"), F.lit(1)), ring)
    up = F.upper(F.trim(text))
    # the parts of a multipolygon lie in double brackets
    parts = F.transform(F.regexp_extract_all(text, F.lit(r"(\((?:\s*\([^()]+\)\s*,?)+\s*\))"), F.lit(1)), rings)
    return F.when(up.rlike(r"^(MULTI)?POLYGON\s*\("), parts)


def parse_footprint(text: Column) -> Column:
    """Parts of a catalogue's footprint: geography'SRID=4326;<WKT>', WKT or GeoJSON; else null."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), r"^geography'", ""), r"'$", "")
    plain = F.regexp_replace(plain, r"^SRID=\d+;", "")
    return F.when(plain.startswith("{"), parse_geojson(plain)).otherwise(parse_wkt(plain))


def ring_area(ring: Column) -> Column:
    """Area of a ring, closed or not, whatever its direction."""
    after = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, after, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2


def shape_area(parts: Column) -> Column:
    """Planar area: outlines less holes."""
    part = lambda rings: F.aggregate(F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0))), ring_area(rings[0]), lambda a, r: a - ring_area(r))
    return F.aggregate(parts, F.lit(0.0), lambda a, rings: a + part(rings))


def bounds(parts: Column) -> dict[str, Column]:
    """west, south, east, north."""
    points = F.flatten(F.flatten(parts))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"west": F.array_min(xs), "south": F.array_min(ys), "east": F.array_max(xs), "north": F.array_max(ys)}


def add_margin(box: dict[str, Column], margin: float = 0.001) -> dict[str, Column]:
    return {"west": box["west"] - margin, "south": box["south"] - margin, "east": box["east"] + margin, "north": box["north"] + margin}


def boxes_meet(a: dict[str, Column], b: dict[str, Column]) -> Column:
    return (a["west"] <= b["east"]) & (b["west"] <= a["east"]) & (a["south"] <= b["north"]) & (b["south"] <= a["north"])


def inside(x: Column, y: Column, parts: Column) -> Column:
    """Whether a point is inside: an odd number of edges crosses the ray to its right."""
    def crossings(ring: Column) -> Column:
        after = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
        hit = lambda p, q: F.when((p["y"] > y) != (q["y"] > y), (x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]).cast("int")).otherwise(0)
        return F.aggregate(F.zip_with(ring, after, hit), F.lit(0), lambda a, v: a + v)

    return F.aggregate(F.flatten(parts), F.lit(0), lambda a, r: a + crossings(r)) % 2 == 1


def explode_parts(zones: DataFrame) -> DataFrame:
    """One row a part."""
    return zones.withColumn("parts", F.explode(F.transform("parts", lambda p: F.array(p))))


def clip_ring(xy: np.ndarray, west: float, south: float, east: float, north: float) -> np.ndarray:
    """A ring clipped against a rectangle, side by side; concave rings keep their signed area."""
    for axis, limit, keep_low in ((0, west, False), (0, east, True), (1, south, False), (1, north, True)):
        if len(xy) == 0:
            return xy
        d = (limit - xy[:, axis]) if keep_low else (xy[:, axis] - limit)
        d2, nxt = np.roll(d, -1), np.roll(xy, -1, axis=0)
        out = []
        for p, q, a, b in zip(xy, nxt, d, d2):
            if a >= 0:
                out.append(p)
            if (a >= 0) != (b >= 0):
                out.append(p + (q - p) * (a / (a - b)))
        xy = np.array(out).reshape(-1, 2)
    return xy


def _area(xy: np.ndarray) -> float:
    if len(xy) < 3:
        return 0.0
    x, y = xy[:, 0] - xy[0, 0], xy[:, 1] - xy[0, 1]
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y))) / 2


def flat(parts: Column) -> dict[str, Column]:
    """A shape as plain arrays: xs, ys, and the ring and hole flag of each point. Nested arrays of unequal lengths don't pass to Python."""
    rings = F.flatten(F.transform(parts, lambda part: F.transform(part, lambda ring, i: F.struct(ring.alias("ring"), (i > 0).alias("hole")))))
    points = F.flatten(F.transform(rings, lambda r, k: F.transform(r["ring"], lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.when(r["hole"], -1 - k).otherwise(k + 1).alias("ring")))))
    return {"xs": F.transform(points, lambda p: p["x"]), "ys": F.transform(points, lambda p: p["y"]), "rings": F.transform(points, lambda p: p["ring"])}


def unflat(xs: np.ndarray, ys: np.ndarray, rings: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(1 or -1 for a hole, points) of each ring."""
    xy, rings = np.column_stack([xs, ys]).astype(float), np.asarray(rings)
    cuts = np.flatnonzero(np.diff(rings)) + 1
    return [(1 if r[0] > 0 else -1, p) for r, p in zip(np.split(rings, cuts), np.split(xy, cuts)) if len(r)]


@pandas_udf(T.DoubleType())
def cell_area(xs: pd.Series, ys: pd.Series, rings: pd.Series, west: pd.Series, south: pd.Series, east: pd.Series, north: pd.Series) -> pd.Series:
    """Area within a rectangle of a shape given by the columns of flat()."""
    out = []
    for x, y, r, w, s, e, n in zip(xs, ys, rings, west, south, east, north):
        out.append(0.0 if x is None else max(sum(sign * _area(clip_ring(xy, w, s, e, n)) for sign, xy in unflat(x, y, r)), 0.0))
    return pd.Series(out)


def union_area(shapes: list[list[list[tuple[float, float]]]], within: list[list[tuple[float, float]]] | None = None) -> float:
    """Area of the union of shapes (lists of rings), in the part of the plane that `within` covers.

    A sweep over the strips between all vertices and crossings: inside a strip edges
    don't cross, so the covered length along it is linear.
    """
    groups = [*shapes, *([within] if within is not None else [])]
    edges = []
    for g, rings in enumerate(groups):
        for ring in rings:
            xy = np.asarray(ring, float)
            for p, q in zip(xy, np.roll(xy, -1, axis=0)):
                if p[0] != q[0]:
                    edges.append((*(p if p[0] < q[0] else q), *(q if p[0] < q[0] else p), g))
    if not edges:
        return 0.0
    e = np.array(edges)
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    base = e[:, 1] - slope * e[:, 0]
    xs = set(e[:, 0]) | set(e[:, 2])
    for i in range(len(e)):
        d = slope[i + 1 :] - slope[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            x = (base[i] - base[i + 1 :]) / d
        ok = np.isfinite(x) & (x > np.maximum(e[i, 0], e[i + 1 :, 0])) & (x < np.minimum(e[i, 2], e[i + 1 :, 2]))
        xs.update(x[ok].tolist())
    cuts, total, last = np.array(sorted(xs)), 0.0, len(shapes)
    group = e[:, 4].astype(int)
    for a, b in zip(cuts, cuts[1:]):
        m = (a + b) / 2
        own = np.flatnonzero((e[:, 0] <= m) & (e[:, 2] >= m))
        ys = slope[own] * m + base[own]
        order = np.argsort(ys, kind="stable")
        parity, covers, wanted, low = [0] * len(groups), 0, within is None, 0.0
        for y, g in zip(ys[order].tolist(), group[own[order]].tolist()):
            was = covers > 0 and wanted
            parity[g] ^= 1
            if g == last:
                wanted = bool(parity[g])
            else:
                covers += 1 if parity[g] else -1
            now = covers > 0 and wanted
            if now and not was:
                low = y
            elif was and not now:
                total += (y - low) * (b - a)
    return float(total)


def coverage(footprints: DataFrame, aoi: DataFrame, by: list[str]) -> DataFrame:
    """by, coverage_pct: the share of the area of interest under the union of each group's footprints (column parts).

    aoi is one row with its parts. A group's footprints are those of one date: tens, not rows of the data.
    """
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shape = lambda p, r: [xy for _, xy in unflat(r[f"{p}xs"], r[f"{p}ys"], r[f"{p}rings"])]
        rows = pdf.to_dict("records")
        area = shape("a", rows[0])
        whole = union_area([area])
        pct = 100 * union_area([shape("f", r) for r in rows], area) / whole if whole else 0.0
        return pd.DataFrame([[*key, pct]], columns=[*by, "coverage_pct"])

    named = lambda p: [c.alias(f"{p}{k}") for k, c in flat(F.col("parts")).items()]
    one = F.broadcast(aoi.select(*named("a")).limit(1))
    kinds = dict(footprints.dtypes)
    # a footprint that comes again covers nothing new
    rows = footprints.where("parts is not null").select(*by, "parts").distinct().select(*by, *named("f")).crossJoin(one)
    # a group costs far more than its bytes tell, so its partitions aren't to be merged by size
    n = int(footprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *by).groupBy(*by).applyInPandas(run, ", ".join([*(f"{b} {kinds[b]}" for b in by), "coverage_pct double"]))


def utm_forward(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Easting and northing in metres on WGS84, by the third-order Krueger series."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(float(epsg % 100 * 6 - 183)))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - c * F.atanh(c * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e, m = eta, xi
    for j, k in enumerate(alpha, 1):
        e = e + k * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        m = m + k * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500_000 + 0.9996 * big * e, (0.0 if epsg // 100 == 326 else 10_000_000.0) + 0.9996 * big * m


def utm_inverse(easting: Column, northing: Column, epsg: int) -> tuple[Column, Column]:
    """Longitude and latitude on WGS84 of a place in a UTM zone, by the same series turned round."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi0 = (northing - (0.0 if epsg // 100 == 326 else 10_000_000.0)) / (0.9996 * big)
    eta0 = (easting - 500_000) / (0.9996 * big)
    xi, eta = xi0, eta0
    for j, k in enumerate(beta, 1):
        xi = xi - k * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - k * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, k in enumerate(delta, 1):
        phi = phi + k * F.sin(2 * j * chi)
    return F.lit(float(epsg % 100 * 6 - 183)) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(phi)


def project(parts: Column, epsg: int) -> Column:
    """A shape in degrees as one in metres."""
    def point(p: Column) -> Column:
        e, n = utm_forward(p["x"], p["y"], epsg)
        return F.struct(e.alias("x"), n.alias("y"))

    return F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, point)))


def hectares(parts: Column, epsg: int) -> Column:
    """Area of a shape in degrees, measured in a UTM zone."""
    return shape_area(project(parts, epsg)) / 10_000
