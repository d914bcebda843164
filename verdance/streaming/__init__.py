"""Structured Streaming forms of the keyed, bounded states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from verdance.operators import temporal as T
from verdance.sources import sinks, tables


def history_sink(path: str, by: list[str], keep: int = 5) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges a batch of detections into the bounded history, and deletes what falls out; a batch that comes again changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        stored = tables.exists(spark, path)
        old = spark.read.parquet(path).select(batch.columns) if stored else batch.limit(0)
        new = T.bounded_history(old, batch, "fecha_deteccion", by, keep)
        # a batch's dates are rewritten, and those of which rows fall out
        count = lambda df, name: df.groupBy("fecha_deteccion").agg(F.count("*").alias(name))
        # one row a date
        n = count(old, "had").join(count(new, "has"), "fecha_deteccion", "full").join(batch.select("fecha_deteccion").distinct().withColumn("now", F.lit(True)), "fecha_deteccion", "left").collect()
        gone = [r["fecha_deteccion"] for r in n if not r["has"]]
        touched = [r["fecha_deteccion"] for r in n if r["has"] and (r["now"] or r["had"] != r["has"])]
        if touched:
            rows = new.where(F.col("fecha_deteccion").isin(touched))
            if stored and any(r["had"] and not r["now"] for r in n if r["fecha_deteccion"] in touched):
                # what is read is rewritten as well: through a copy beside it
                copy = f"{path}.next"
                rows.write.mode("overwrite").parquet(copy)
                rows = spark.read.schema(rows.schema).parquet(copy)
            sinks.write_history(rows, path)
        sinks.drop_dates(spark, path, gone)

    return merge


def stream_history(stream: DataFrame, path: str, checkpoint: str, by: list[str], keep: int = 5) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(history_sink(path, by, keep)).option("checkpointLocation", checkpoint)


def cloud_windows(scenes: DataFrame, time: str = "ts", every: str = "5 days", late: str = "10 days") -> DataFrame:
    """Cloud share of scenes by tumbling window, with late scenes taken up to a limit. scenes: time, total, cloud."""
    return scenes.withWatermark(time, late).groupBy(F.window(time, every).alias("w")).agg(F.sum("total").alias("total"), F.sum("cloud").alias("cloud")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "total", "cloud", F.when(F.col("total") > 0, 100.0 * F.col("cloud") / F.col("total")).alias("cloud_pct"))
