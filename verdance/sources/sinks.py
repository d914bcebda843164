"""Writers: products by partition, replacement by date and mill, logs, names of published rasters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.functions import scalar as S
from verdance.operators import publish as P

KEYS = ["producto", "fecha_img", "ingenio"]


def write_product(df: DataFrame, path: str, product: str) -> None:
    """Overwrite only the partitions that df has: a date that is run again replaces itself."""
    rows = df.withColumn("producto", F.lit(product))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*[k for k in KEYS if k in rows.columns]).parquet(path)


def write_history(df: DataFrame, path: str) -> None:
    """Overwrite the history by detection date."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fecha_deteccion").parquet(path)


def drop_dates(spark: SparkSession, path: str, dates: list) -> None:
    """Delete the history's partitions of some dates."""
    for d in dates:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/fecha_deteccion={d}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def replace_published(df: DataFrame, path: str, keys: tuple[str, ...] = ("fecha_img", "ingenio")) -> int:
    """Rows in place of those of the same date and mill; returns how many."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return df.count()


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, dry_run: bool = False, properties: dict[str, str] | None = None, replace: tuple[str, ...] = ("fecha_img", "ingenio")) -> int:
    """Rows in batches, in place of those that agree in the `replace` columns; returns how many. A dry run only counts.

    A run's dates and mills are few; their rows are deleted in one transaction before.
    """
    n = df.count()
    if dry_run or not n:
        return n
    own = properties or {}
    keys = [k for k in replace if k in df.columns]
    if keys:
        found = df.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct().collect()
        jvm = df.sparkSession.sparkContext._jvm
        given = jvm.java.util.Properties()
        for k, v in own.items():
            given.setProperty(k, v)
        if "driver" in own:
            jvm.java.lang.Class.forName(own["driver"])
        connection = jvm.java.sql.DriverManager.getConnection(url, given)
        try:
            if connection.getMetaData().getTables(None, None, table.upper(), None).next() or connection.getMetaData().getTables(None, None, table, None).next():
                connection.setAutoCommit(False)
                gone = connection.prepareStatement(f"DELETE FROM {table} WHERE " + " AND ".join(f'CAST("{k}" AS VARCHAR(200)) = ?' for k in keys))
                for r in found:
                    for i, k in enumerate(keys):
                        gone.setString(i + 1, r[k])
                    gone.execute()
                connection.commit()
        finally:
            connection.close()
    df.write.jdbc(url, table, mode="append", properties={"batchsize": str(batch), **own})
    return n


def push(files: dict[str, Callable[[], DataFrame]], write: Callable[[DataFrame, str], int]) -> list[dict]:
    """Each file's complete rows, in the types of the table that its name gives, written; a row of figures each.

    Files that name no table are left out. An error stops its file and no other.
    """
    out = []
    for name, read in files.items():
        table = next((t for k, t in (("NDVI", "data_ndvi"), ("NDWI", "data_ndwi"), ("SMART_GROWTH", "data_sg"), ("WEED", "data_maleza"), ("MALEZA", "data_maleza")) if k in name.upper()), None)
        if table is None:
            continue
        row = {"file_name": name, "table_name": table, "rows": None, "written": None, "misfits": None, "error": None}
        try:
            df = read()
            good, misfits = P.published_types(P.complete_rows(df), table)
            row |= {"rows": df.count(), "misfits": misfits.count(), "written": write(good, table)}
        except Exception as e:  # one file's failure is its own
            row["error"] = str(e)
        out.append(row)
    return out


def write_log(df: DataFrame, path: str) -> bool:
    """Write a log as CSV, if there is anything to write."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").csv(path, header=True)
    return True


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def published_name(path: Column, prefix: str, location: str) -> Column:
    """Conventional name of an index raster: PREFIX_LOCATION_INDEX_YYYY_MM_DD.tif; null for cloud-free scenes and other files."""
    name = F.element_at(F.split(path, "/"), -1)
    index = F.upper(F.regexp_extract(F.lower(name), r"(ndvi|ndwi|ndre|evi|savi)", 1))
    date = S.parse_date(F.regexp_extract(name, r"(\d{4}[-_]?\d{2}[-_]?\d{2})", 1))
    good = ~F.lower(name).startswith("cloud_free") & (index != "") & date.isNotNull()
    return F.when(good, F.concat(F.concat_ws("_", F.lit(prefix), F.lit(location), index, F.date_format(date, "yyyy_MM_dd")), F.lit(".tif")))


def to_copy(files: DataFrame, existing: DataFrame, prefix: str, location: str) -> DataFrame:
    """path, name of the rasters whose conventional name isn't there yet."""
    named = files.select("path", published_name(F.col("path"), prefix, location).alias("name")).where("name is not null")
    return named.join(existing.select("name").distinct(), "name", "left_anti")
