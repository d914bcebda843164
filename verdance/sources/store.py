"""Tables that a plan writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def place(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir; it goes when the application ends.

    Where that is unset, a local session gets a temporary folder and a cluster the warehouse folder.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not base:
        if not (spark.sparkContext.master or "").startswith("local"):
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        else:
            base = tempfile.mkdtemp(prefix="verdance-files-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    path = f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame) -> DataFrame:
    """df, written once and read again: cuts the lineage, survives lost executors."""
    path = place(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
