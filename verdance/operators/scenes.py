"""Choice of scenes: coverage, inference date with fallbacks, previous dates, radar pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.operators import temporal as T

COVERAGE, PREVIOUS = 95.0, 5


def dedupe_catalogue(products: DataFrame) -> DataFrame:
    """One product a date and tile: the earliest acquisition."""
    return T.top_by(products, ["date", "tile_id"], [F.col("product_name").asc()])


def date_coverage(products: DataFrame, aoi: DataFrame) -> DataFrame:
    """date, coverage_pct, cloud_cover (mean of the tiles that meet the area), is_complete."""
    area = F.broadcast(aoi.select(*[c.alias(f"__{k}") for k, c in G.bounds(F.col("parts")).items()]).limit(1))
    shapes = dedupe_catalogue(products).withColumn("parts", G.parse_footprint(F.col("footprint"))).where("parts is not null")
    box = G.bounds(F.col("parts"))
    near = shapes.crossJoin(area).where(G.boxes_meet(box, {k: F.col(f"__{k}") for k in box}))
    clouds = near.groupBy("date").agg(F.avg("cloud_cover").alias("cloud_cover"))
    return G.coverage(near, aoi, ["date"]).join(clouds, "date").withColumn("is_complete", F.col("coverage_pct") >= COVERAGE)


def inference_date(days: DataFrame, first: Column, last: Column, coverage: str = "coverage_pct", complete: str = "is_complete", fallback: bool = True) -> DataFrame:
    """One row: date, is_broken.

    The newest complete date of the window; else the window's date of largest
    coverage (ties: the earliest), broken; else the newest complete date before it.
    Without `fallback` the first alone: null if the window has no complete date.
    """
    inside = F.col("date").between(first, last)
    got = days.agg(
        F.max(F.when(inside & F.col(complete), F.col("date"))).alias("o1"),
        F.max_by(F.when(inside, F.col("date")), F.when(inside & (F.col(coverage) > 0), F.struct(F.col(coverage), -F.unix_date("date")))).alias("o2"),
        F.max(F.when((F.col("date") < first) & F.col(complete), F.col("date"))).alias("o3"))
    if not fallback:
        return got.select(F.col("o1").alias("date"), F.lit(False).alias("is_broken"))
    return got.select(F.coalesce("o1", "o2", "o3").alias("date"), (F.col("o1").isNull() & F.col("o2").isNotNull()).alias("is_broken"))


def select_scenes(days: DataFrame, radar: DataFrame, first: Column, last: Column, previous: int = PREVIOUS, previews: DataFrame | None = None, fallback: bool = True) -> DataFrame:
    """role, slot, date, s1_date, s1_diff_days of the inference scene and the newest complete ones before it.

    previews: (date, is_complete) of coarse looks at the chosen dates; one that turns
    out incomplete goes, and the next older complete date takes its place.
    Without `fallback` a window without a complete date has no scenes.
    """
    chosen = inference_date(days, first, last, fallback=fallback)
    one = chosen.select(F.col("date").alias("__chosen"))
    older = days.join(F.broadcast(one), F.col("date") < F.col("__chosen")).where("is_complete").select("date").distinct()
    n = F.row_number().over(Window.orderBy(F.desc("date")))
    older = older.withColumn("slot", n)
    if previews is not None:
        bad = previews.where(~F.col("is_complete")).select("date").distinct().withColumn("__bad", F.lit(True))
        older = older.join(bad, "date", "left").withColumn("__bad", F.coalesce("__bad", F.lit(False)) & (F.col("slot") <= previous))
        lost = F.count_if("__bad").over(Window.partitionBy())
        older = older.withColumn("__lost", lost).where(~F.col("__bad") & (F.col("slot") <= previous + F.col("__lost"))).select("date").withColumn("slot", n)
    older = older.where(F.col("slot") <= previous)
    rows = chosen.where("date is not null").select("date", F.lit(0).alias("slot")).unionByName(older)
    rows = rows.withColumn("role", F.when(F.col("slot") == 0, "inference").otherwise(F.format_string("prev%02d", F.col("slot"))))
    return T.nearest_date(rows, radar, "date", "date_s1" if "date_s1" in radar.columns else "date", "s1_date", "s1_diff_days")


def pick_file(files: DataFrame, by: list[str], exact: list[str], least: int = 1000) -> DataFrame:
    """One file a group: the first exact name in order, else the largest of at least `least` bytes; ties to the newer, then the smaller path."""
    rank = F.lit(len(exact))
    for i, name in reversed(list(enumerate(exact))):
        rank = F.when(F.col("path").endswith(name), i).otherwise(rank)
    return T.top_by(files.where((F.col("length") >= least) | (rank < len(exact))), by, [rank.asc(), F.desc("length"), F.desc("modificationTime"), F.asc("path")])


def pair_summary(pairs: DataFrame) -> DataFrame:
    """pairs, valid and success_pct (100 if there are none)."""
    ok = F.col("s2_exists") & F.col("s1_exists")
    return pairs.agg(F.count("*").alias("pairs"), F.count_if(ok).alias("valid"), F.when(F.count("*") == 0, 100.0).otherwise(100.0 * F.count_if(ok) / F.nullif(F.count("*"), F.lit(0))).alias("success_pct"))


def match_pairs(files: DataFrame) -> DataFrame:
    """role, scene_date, s2_file, s1_file, s2_exists, s1_exists of pair folders, from (path, length, role, scene_date, kind). A file under 1000 bytes isn't there; of several the largest, then the smaller path."""
    best = lambda k: F.max_by(F.when(F.col("kind") == k, F.col("path")), F.when((F.col("kind") == k) & (F.col("length") >= 1000), F.struct("length", F.reverse("path"))))
    out = files.where("role is not null").groupBy("role", "scene_date").agg(best("s2").alias("s2_file"), best("s1").alias("s1_file"))
    return out.withColumns({"s2_exists": F.col("s2_file").isNotNull(), "s1_exists": F.col("s1_file").isNotNull()})
