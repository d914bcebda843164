"""Operators on dates: nearest and previous dates, slots, bounded history, top-1 by season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_date(left: DataFrame, right: DataFrame, left_date: str, right_date: str, out: str = "nearest", diff: str = "diff_days") -> DataFrame:
    """left with the nearest of right's dates, before or after, and the days between; ties go to the later date.

    One sorted pass over both date sets finds the last date before and the first after;
    dates are distinct days, so the window holds days, not rows.
    """
    days = left.select(F.col(left_date).alias("d")).where("d is not null").distinct().select("d", F.lit(0).alias("__right"))
    other = right.select(F.col(right_date).alias("d")).where("d is not null").distinct().select("d", F.lit(1).alias("__right"))
    both = days.unionByName(other)
    own = F.when(F.col("__right") == 1, F.col("d"))
    # years as partitions would lose neighbours across their borders; distinct days are few
    before = F.max(own).over(Window.orderBy("d").rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(own).over(Window.orderBy("d").rangeBetween(0, Window.unboundedFollowing))
    near = both.withColumns({"b": before, "a": after}).where("__right = 0")
    later = F.col("b").isNull() | (F.datediff("a", "d") <= F.datediff("d", "b"))
    pick = F.when(F.col("a").isNotNull() & later, F.col("a")).otherwise(F.col("b"))
    table = near.select(F.col("d").alias("__d"), pick.alias(out)).withColumn(diff, F.abs(F.datediff(out, "__d")))
    return left.join(table, F.col(left_date) == F.col("__d"), "left").drop("__d")


def previous_dates(scenes: DataFrame, target: Column, by: list[str], date: str = "scene_date", most: int = 5, others: bool = False) -> DataFrame:
    """The newest `most` dates strictly before the target, newest first in slot 1; with `others`, a group without any takes its newest other dates."""
    w = Window.partitionBy(*by)
    rows = scenes.select(*by, date).distinct()
    if others:
        rows = rows.where(F.col(date) != target).withColumn("__any", F.max(F.col(date) < target).over(w)).where((F.col(date) < target) | ~F.col("__any")).drop("__any")
    else:
        rows = rows.where(F.col(date) < target)
    return rows.withColumn("slot", F.row_number().over(w.orderBy(F.desc(date)))).where(F.col("slot") <= most)


def slots(dates: DataFrame, date: str = "date", most: int = 5) -> DataFrame:
    """role, slot by newness: slot 0 is inference, slots 1 to `most` are prev01...; older dates go."""
    n = F.row_number().over(Window.orderBy(F.desc(date))) - 1
    role = F.when(F.col("slot") == 0, "inference").otherwise(F.format_string("prev%02d", F.col("slot")))
    return dates.select(date).distinct().withColumn("slot", n).where(F.col("slot") <= most).withColumn("role", role)


def inference_window(start: Column, end: Column, days: int = 5) -> Column:
    """The array of `days` dates from start; an end before the start is an error."""
    return F.when(F.assert_true(end >= start, F.lit("the window ends before it begins")).isNull(), F.sequence(start, F.date_add(start, days - 1)))


def top_by(rows: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group in an order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def past_record(table: DataFrame, season: int, keys: list[str]) -> DataFrame:
    """The newest earlier season's row of each key; seasons compare as numbers."""
    number = F.col("zafra").try_cast("int")
    return top_by(table.where(number < season), keys, [number.desc()])


def bounded_history(history: DataFrame, current: DataFrame, date: str, by: list[str], keep: int = 5) -> DataFrame:
    """history with the current date's rows put in place of any of that date, and the newest `keep` dates of each group kept."""
    now = current.select(*by, F.col(date).alias("__now")).distinct()
    rest = history.alias("h").join(now.alias("n"), [F.col(f"h.{b}") == F.col(f"n.{b}") for b in by] + [F.col(f"h.{date}") == F.col("n.__now")], "left_anti") if by else history.join(now, F.col(date) == F.col("__now"), "left_anti")
    both = rest.unionByName(current, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(F.desc(date))
    return both.withColumn("__rank", F.dense_rank().over(w)).where(F.col("__rank") <= keep).drop("__rank")


def overlap_count(history: DataFrame, piece: list[str], date: str | None = None, cap: int = 5) -> DataFrame:
    """In how many detections each piece occurs, at most `cap`: by rows, or by distinct dates."""
    n = F.count_distinct(date) if date else F.count("*")
    return history.groupBy(*piece).agg(F.least(n, F.lit(cap)).cast("int").alias("overlap_count"))


def missing(needed: DataFrame, have: DataFrame, on: list[str]) -> DataFrame:
    """What is needed and not there."""
    return needed.join(have.select(*on).distinct(), on, "left_anti")


def lookback(date: Column, end: Column, days: int = 30, margin: int = 0) -> Column:
    """Whether a date lies in the `days` up to the end, widened by a margin on both sides."""
    return date.between(F.date_sub(end, days + margin), F.date_add(end, margin))
