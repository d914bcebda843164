"""Scans of sheets, parcels, curves, catalogues, products and folders."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.functions import scalar as S

PARCEL_COLUMNS = ["id_parcela", "zafra", "fecha_inicio", "geometry_polygon", "ingenio", "company", "ingenio_id", "company_id", "area_calculada"]


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV (with a header, all text), JSON lines or Parquet, by the path's ending."""
    low = path.lower()
    if low.endswith(".csv"):
        return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    return spark.read.json(path) if low.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def read_sheets(spark: SparkSession, paths: dict[int, str]) -> dict[int, DataFrame]:
    """Sheets by season, with trimmed lower-case headers, the season as `zafra`, and the row order. A sheet that can't be read is empty; if none can, that is an error."""
    out, bad = {}, []
    for season, path in paths.items():
        try:
            df = read_any(spark, path)
            df = df.toDF(*[c.strip().lower() for c in df.columns])
            out[season] = df.withColumn("zafra", F.lit(season).cast("string")).withColumn("__order", F.monotonically_increasing_id())
        except AnalysisException as e:
            bad.append(str(e))
            out[season] = spark.createDataFrame([], "id_parcela string, ingenio string, zafra string, fecha_inicio string, fecha_fin string, ciclo string, __order long")
    if bad and len(bad) == len(paths):
        raise FileNotFoundError("; ".join(bad))
    return out


def read_parcels(spark: SparkSession, path: str | None, mill: str, jdbc: dict[str, str] | None = None, strict: bool = False) -> DataFrame:
    """Active parcels of a mill: the columns that products need, with both predicates left to the scan; `parts` from the geometry. Parcels without a polygon go.

    strict: no parcel is an error, and ids that repeat are warned of.
    """
    df = spark.read.format("jdbc").options(**jdbc).load() if jdbc else read_any(spark, path)
    df = df.select([c for c in PARCEL_COLUMNS + ["temporada_activa"] if c in df.columns])
    df = df.where((F.col("ingenio") == mill) & F.col("temporada_activa"))
    out = df.drop("temporada_activa").withColumn("parts", G.parse_geojson(F.col("geometry_polygon"))).where("parts is not null")
    if strict:
        # one row
        n, ids = out.agg(F.count("*"), F.count_distinct("id_parcela")).first()
        if not n:
            raise LookupError(f"no active parcel of {mill}")
        if ids < n:
            warnings.warn(f"{n - ids} rows repeat a parcel of {mill}", stacklevel=2)
    return out


def read_area(spark: SparkSession, path: str, margin: float = 0.001) -> DataFrame:
    """One row: the area of interest (parts) of a GeoJSON file, and its box with a margin (west, south, east, north)."""
    parts = read_geojson(spark, path).agg(F.flatten(F.collect_list("parts")).alias("parts"))
    box = G.add_margin(G.bounds(F.col("parts")), margin)
    return parts.select("parts", *[c.alias(k) for k, c in box.items()])


def read_geojson(spark: SparkSession, path: str, season: str | None = None) -> DataFrame:
    """A row for each feature: its properties, and its parts; `zafra` by default the given season."""
    raw = spark.read.text(path, wholetext=True)
    features = raw.select(F.explode(F.from_json("value", "struct<features:array<struct<properties:map<string,string>,geometry:string>>>")["features"]).alias("f"))
    out = features.select(F.col("f.properties").alias("properties"), G.parse_geojson(F.col("f.geometry")).alias("parts"))
    names = [r[0] for r in out.select(F.explode(F.map_keys("properties")).alias("k")).distinct().orderBy("k").collect()]
    out = out.select(*[F.col("properties")[n].alias(n) for n in names], "parts")
    return out if "zafra" in names or season is None else out.withColumn("zafra", F.lit(season))


def read_curve(spark: SparkSession, path: str) -> DataFrame | None:
    """The curve (edad_dias, <index>_potencial), or nothing if there is none: then the polynomials hold. A curve that can't be read is an error."""
    return read_any(spark, path) if exists(spark, path) else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at a path, which may hold wildcards."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at))


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product files with their name and the table that it names."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    # a product that was written in parts is a folder
    parts = F.split(F.input_file_name(), "/")
    name = F.when(F.element_at(parts, -1).startswith("part-"), F.element_at(parts, -2)).otherwise(F.element_at(parts, -1))
    return df.withColumn("file_name", name).withColumn("table_name", S.published_table(F.col("file_name")))


CATALOGUE = "value array<struct<Id:string,Name:string,Footprint:string,ContentDate:struct<Start:string>,Attributes:array<struct<Name:string,Value:string>>>>"


def read_catalogue(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """date, tile_id, product_name, product_id, footprint, cloud_cover from saved catalogue answers (JSON): one a file, or with `lines` one a line.

    What follows a first answer in its file, or in its line, isn't read.
    """
    return catalogue_rows(spark.read.schema(CATALOGUE).json(path, multiLine=not lines))


def catalogue_rows(answers: DataFrame) -> DataFrame:
    """One row a product of the answers."""
    rows = answers.select(F.explode("value").alias("p"))
    return rows.select(
        F.coalesce(S.scene_date(F.col("p.Name")), F.try_to_date(F.substring("p.ContentDate.Start", 1, 10))).alias("date"), S.tile_of(F.col("p.Name")).alias("tile_id"), F.col("p.Name").alias("product_name"),
        F.col("p.Id").alias("product_id"), F.col("p.Footprint").alias("footprint"), S.first_cloud_cover(F.col("p.Attributes")).alias("cloud_cover"))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modificationTime, role, scene_date, kind of the rasters in pair folders; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif").load(path).select("path", "length", "modificationTime")
    role, date = S.folder_role(F.col("path"))
    low = F.lower(F.element_at(F.split("path", "/"), -1))
    return files.withColumns({"role": role, "scene_date": date, "kind": F.when(low.contains("s1"), "s1").otherwise("s2")})


def read_history(spark: SparkSession, path: str, mill: str | None = None) -> DataFrame | None:
    """The weed history, of one mill if given; nothing if there is none yet."""
    if not exists(spark, path):
        return None
    df = spark.read.parquet(path)
    return df if mill is None else df.where(S.normalized_name(F.col("ingenio")) == S.normalized_name(F.lit(mill)))
