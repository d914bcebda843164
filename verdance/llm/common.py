"""What several operators share: shared storage, tables, per-row Arrow kernels."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdance.session import ship

__all__ = ["WORD", "discard", "fold_of", "labelled_sample", "map_batches", "materialize", "shared_dir", "ship", "table", "text_bytes"]

#: Word: a run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is spark.checkpoint.dir of the session. Where that is unset, a local
    session gets a temporary folder and a cluster the warehouse folder.
    """
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    own = tempfile.mkdtemp(prefix="verdance-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors. The table goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_written"] = lambda: files.delete(place, True)
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that materialize wrote and that nothing will read again."""
    if delete := df.__dict__.pop("_written", None):
        delete()


#: Bytes of an Arrow batch that a kernel gets at once; a longer row comes alone.
SLICE = 8 << 20


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """Apply fn to every Arrow batch, in slices of bounded bytes; fn returns a batch in the order of schema."""
    want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, batch.num_rows * SLICE // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, rows):
                yield fn(batch.slice(at, rows))

    return df.mapInArrow(run, want)


def text_bytes(col: str = "text"):
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def fold_of(col, k: int):
    """crc32 of the id as text, modulo k: the fold that a labelled row belongs to."""
    return F.crc32(col.cast("string").cast("binary")) % k


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, held: int, rows: int, per_class: bool = True) -> DataFrame:
    """(text, y) of at most `rows` labelled documents outside the held-out fold.

    The sample is the rows with the smallest hash of their id, half of it for
    each class if per_class; `rows` bounds what a model is fitted on. Null
    labels are no labels; several rows for an id count once (the largest label).
    """
    own = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold_of(F.col("doc_id"), fold) != held))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .withColumn("h", F.xxhash64(F.lit("labelled"), F.col("doc_id")))
    )
    if per_class:
        parts = [own.where(F.col("y") == y).orderBy("h", "doc_id").limit(rows // 2) for y in (0, 1)]
        own = parts[0].unionByName(parts[1])
    else:
        own = own.orderBy("h", "doc_id").limit(rows)
    # at most `rows` ids: a proven bound for the broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(own), "doc_id")
    # of rows that repeat an id, the smallest text
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
