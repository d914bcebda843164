"""Scalar rules as column expressions. Nothing here runs Python on executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdance.functions import tables as K

Ranges = list[tuple[float, float, int]]


def age_days(image: Column, start: Column, most: int = 450) -> Column:
    """Days from start to image, at most `most`; negative ages stay; null if either is null."""
    days = F.datediff(image, start)
    return F.when(days.isNull(), None).otherwise(F.least(days, F.lit(most)))


def days_between(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def growth_stage(age: Column) -> Column:
    """Phenological stage of an age in days."""
    return (
        F.when(age.isNull(), "SF").when(age <= 60, "Iniciacion").when(age <= 120, "Macollamiento")
        .when(age <= 210, "Elongacion I").when(age <= 300, "Elongacion II").otherwise("Maduracion"))


def reclassify(value: Column, ranges: Ranges, kind: str = "double") -> Column:
    """Class of the last range [low, high) that holds the value; null if none does.

    kind "float" compares in single precision, as single-precision rasters need.
    """
    cast = lambda x: F.lit(x).cast(kind)
    out = None
    for low, high, k in reversed(ranges):
        hit = (value >= cast(low)) & (value < cast(high))
        out = F.when(hit, F.lit(k)) if out is None else out.when(hit, F.lit(k))
    return out


def polynomial(x: Column, coefficients: list[float]) -> Column:
    """Horner's scheme, highest power first."""
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def potential(region: Column, index: str, age: Column) -> Column:
    """Expected index at an age, by the region's polynomial; null for other regions."""
    out = F.lit(None).cast("double")
    for (name, of), c in K.POTENTIAL.items():
        if of == index:
            out = F.when(region == name, polynomial(age.cast("double"), c)).otherwise(out)
    return out


def normalized_difference(a: Column, b: Column, eps: float = 1e-6) -> Column:
    """(a - b) / (a + b + eps), clipped to [-1, 1]; null if the divisor is zero."""
    d = a + b + F.lit(eps)
    return F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.when(d != 0, (a - b) / d)))


def ndre(b08: Column, b05: Column) -> Column:
    return normalized_difference(b08.cast("double"), b05.cast("double"))


def ndwi(b08: Column, b11: Column) -> Column:
    return normalized_difference(b08.cast("double"), b11.cast("double"))


def smart_growth(ndvi_class: Column, ndwi_class: Column) -> Column:
    """Combined growth score, 20 to 100; null if either class is."""
    return F.lit(12) * ndvi_class + F.lit(8) * ndwi_class


def weed_threshold(mean: Column, deviation: Column) -> Column:
    return mean + F.lit(1.5) * deviation


def valid_threshold(threshold: Column) -> Column:
    return threshold.isNotNull() & (threshold > 0) & (threshold < 1)


def round_half_even(x: Column, digits: int = 2) -> Column:
    """Rounds the scaled double to the even neighbour, as array libraries do."""
    return F.rint(x * F.lit(10.0**digits)) / F.lit(10.0**digits)


def weed_percent(weed_area: Column, area: Column) -> Column:
    return F.when(area > 0, round_half_even(weed_area / area * 100)).otherwise(F.lit(0.0))


def weed_status(percent: Column) -> Column:
    return F.when(percent >= K.CRITICAL_WEED_PERCENT, "Critica").otherwise("Evaluar")


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).when(b == 0, F.lit(0.0))


def raster_math(a: Column, b: Column, operation: str) -> Column:
    """divide, multiply, add or subtract; null where either is."""
    both = a.isNotNull() & b.isNotNull()
    value = {"divide": lambda: safe_divide(a, b), "multiply": lambda: a * b, "add": lambda: a + b, "subtract": lambda: a - b}[operation]()
    return F.when(both, value)


def whole_number(text: Column) -> Column:
    """Numeric text cut to a whole number: '2.9' is 2; null if not numeric or infinite."""
    d = F.expr("1") * 0 + text.try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), None).otherwise(d.try_cast("bigint"))


def cycle_check(past: Column, new: Column) -> Column:
    """Why a cycle number may follow another: ok_* or invalid_*, by the order of rules.

    past and new are text. A null new cycle is fine, a non-numeric one is not; without
    a numeric past one anything goes; else it goes up by one or starts again at 0.
    """
    p, n = whole_number(past), whole_number(new)
    return (
        F.when(new.isNull(), "ok_empty").when(n.isNull(), "invalid_not_numeric").when(p.isNull(), "ok_no_past")
        .when(n == p + 1, "ok_next").when(n == 0, "ok_restart").otherwise("invalid_jump"))


def cleaned(text: Column) -> Column:
    """Trimmed text; the tokens that spreadsheets leave for nothing become null."""
    t = F.trim(text.cast("string"))
    return F.when(t.isin(K.NULL_TOKENS), None).otherwise(t)


def coerce_number(text: Column) -> Column:
    """Number or null; infinities are null here and reported by is_infinite."""
    d = cleaned(text).try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), None).otherwise(d)


def is_infinite(text: Column) -> Column:
    return F.coalesce(F.abs(cleaned(text).try_cast("double")) == F.lit(float("inf")), F.lit(False))


def coerce_boolean(text: Column) -> Column:
    t = cleaned(text)
    return F.when(t.isNotNull(), F.lower(t).isin("true", "1", "yes"))


def parse_date(text: Column) -> Column:
    """A date from 2024-1-5, 2024-01-05, 20240105, 2024_01_05 or a timestamp's text; else null."""
    t = cleaned(text)
    digits = F.regexp_extract(t, r"^(\d{4})[-_/]?(\d{1,2})[-_/]?(\d{1,2})(?:[T ].*)?$", 0)
    parts = [F.regexp_extract(t, r"^(\d{4})[-_/](\d{1,2})[-_/](\d{1,2})(?:[T ].*)?$", i) for i in (1, 2, 3)]
    split = F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    compact = F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.when(parts[0] != "", F.try_to_date(split, "yyyy-MM-dd")).when(t.rlike(r"^\d{8}$"), F.try_to_date(compact, "yyyy-MM-dd")).when(digits != "", F.lit(None).cast("date"))


def coerce_column(name: str, text: Column) -> Column:
    """A spreadsheet cell in the type of its column."""
    if name in K.NUMERIC_COLUMNS or name.startswith("division_"):
        return coerce_number(text)
    if name in K.BOOLEAN_COLUMNS:
        return coerce_boolean(text)
    if name in K.DATE_COLUMNS:
        return parse_date(text)
    if name == "zafra":
        return whole_number(cleaned(text)).cast("string")
    return cleaned(text)


def normalized_name(name: Column) -> Column:
    """A mill's name for comparison: lower case, underscores as spaces."""
    return F.lower(F.translate(name, "_", " "))


def scene_date(product_name: Column) -> Column:
    return F.try_to_date(F.regexp_extract(product_name, r"_(\d{8})T\d{6}_", 1), "yyyyMMdd")


def tile_of(product_name: Column) -> Column:
    return F.nullif(F.regexp_extract(product_name, r"_T(\d{2}[A-Z]{3})_", 1), F.lit(""))


def folder_role(path: Column) -> tuple[Column, Column]:
    """Role and date of a pair folder: inference_<date> or prevNN_<date>."""
    role = F.nullif(F.regexp_extract(path, r"(inference|prev\d+)_\d{4}-?\d{2}-?\d{2}", 1), F.lit(""))
    return role, parse_date(F.regexp_extract(path, r"(?:inference|prev\d+)_(\d{4}-?\d{2}-?\d{2})", 1))


def first_cloud_cover(attributes: Column) -> Column:
    """The value of the first (Name, Value) attribute whose name holds 'cloudcover', in any case."""
    own = F.filter(attributes, lambda a: F.contains(F.lower(a["Name"]), F.lit("cloudcover")))
    return F.try_element_at(own, F.lit(1))["Value"].try_cast("double")


def published_table(file_name: Column) -> Column:
    """The table that a product file goes to; the first name that it holds; null if none."""
    up, out = F.upper(file_name), F.lit(None).cast("string")
    for name, table in reversed([("NDVI", "data_ndvi"), ("NDWI", "data_ndwi"), ("SMART_GROWTH", "data_sg"), ("WEED", "data_maleza"), ("MALEZA", "data_maleza")]):
        out = F.when(F.contains(up, F.lit(name)), F.lit(table)).otherwise(out)
    return out


def file_name(country: Column, company: Column, product: Column, mill: Column, date: Column) -> Column:
    """Name of a product file, with the date zero-padded."""
    return F.concat(F.concat_ws("_", country, company, F.lit("DATA"), product, mill, F.date_format(date, "yyyy_MM_dd")), F.lit(".parquet"))


def elapsed(seconds: Column) -> Column:
    """1h 02m 03s, 2m 03s or 3s."""
    s = seconds.cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, s % 60)).when(m > 0, F.format_string("%dm %02ds", m, s % 60)).otherwise(F.format_string("%ds", s))


def utm_epsg(lon: Column, lat: Column) -> Column:
    zone = F.floor((lon + 180) / 6) + 1
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")


def sniff_crs(x: Column, y: Column, default: int = 32615) -> Column:
    """EPSG code that a first vertex looks like: degrees, else metres in the default zone, else taken as degrees."""
    degrees = (F.abs(x) < 180) & (F.abs(y) < 90)
    return F.when(degrees, 4326).when(F.abs(x).between(100_000, 900_000), default).otherwise(4326)


def bbox_km2(west: Column, south: Column, east: Column, north: Column) -> Column:
    return (east - west) * 111 * (north - south) * 111


def clip_cast(value: Column, kind: str) -> Column:
    """Clipped to [0, the type's largest] and cut to whole numbers."""
    top = {"tinyint": 127, "smallint": 32767, "int": 2147483647}[kind]
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0)), F.lit(top)).cast(kind))


def radar_valid(vv: Column, vh: Column) -> Column:
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (v != 0) & (F.abs(v) < 1e6)
    return ok(vv) & ok(vh)


def confidence(previous: Column, cloud_pct: Column, nodata_pct: Column, cloud: Column, temporal: Column, fusion: Column, spatial: Column) -> dict[str, Column]:
    """Confidence of a filled scene: its four parts, their weighted sum and level."""
    k = F.least(previous, F.lit(5))
    prev = F.when(k >= 5, 100.0).when(k == 4, 90.0).when(k == 3, 75.0).when(k == 2, 55.0).when(k == 1, 30.0).otherwise(5.0)
    clouds = F.when(cloud_pct <= 0, 100.0).when(cloud_pct >= 100, 5.0).otherwise(F.greatest(F.lit(5.0), 100 - 0.8 * F.pow(F.greatest(cloud_pct, F.lit(0.0)), F.lit(1.3))))
    nodata = F.when(nodata_pct <= 0, 100.0).when(nodata_pct >= 50, 5.0).otherwise(F.greatest(F.lit(5.0), 100 - 2 * nodata_pct))
    fill = F.when(cloud <= 0, 100.0).otherwise(F.least(F.lit(100.0), F.greatest(F.lit(5.0), (100 * temporal + 75 * fusion + 40 * spatial) / F.when(cloud != 0, cloud))))
    total = F.least(F.lit(100.0), F.greatest(F.lit(0.0), 0.30 * prev + 0.25 * clouds + 0.30 * fill + 0.15 * nodata))
    level = F.when(total >= 85, "HIGH").when(total >= 65, "MEDIUM").when(total >= 40, "LOW").when(total >= 20, "VERY LOW").otherwise("MINIMAL")
    return {"confidence_previous": prev, "confidence_cloud": clouds, "confidence_fill": fill, "confidence_nodata": nodata, "confidence_overall": total, "confidence_level": level}


def filled_percent(filled: Column, cloud: Column) -> Column:
    return F.when(cloud > 0, filled * 100 / F.greatest(cloud, F.lit(1))).otherwise(F.lit(0.0))
