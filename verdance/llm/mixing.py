"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions alone.

Targets are the weights' shares of the budget, none above `most` times its source:
the smallest common factor that fills the budget is found by sorting the sources by
the factor at which each is full. A source is taken whole as often as its target holds
it (complete epochs); of the rest, documents are taken by the smallest exponential key,
-ln(u) / quality, until their running sum would pass what is left. One closing
document, the one whose size is nearest to what is then left, is taken if that brings
the source nearer to its target.

The running sum is in levels: a source's keys are cut into slices at quantiles of that
source, whatever the weights, and the slices' sums are added up; the slice in which the
budget ends is cut again, until it is small, and only then sorted. Slices are cut at
sampled quantiles but their sums are exact. So a hot source is sorted in one small slice,
and its rows are never in one task. Rows whose keys are all equal are one slice; they are
told apart by id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.llm.common import WORD, materialize

#: Slices of a source's keys, and rows that are sorted in one task, about.
SLICES, SORTED = 512, 20_000
PATTERN = (5.0, 2.0, 1.0)


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "+")), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """Weight of a document's key, from 1/9 to 1, where no quality is given: the share of its characters that aren't letters, digits or white space counts against it."""
    marks = F.length(text) - F.length(F.regexp_replace(text, r"[^\p{L}\p{N}\x09-\x0D\x20]+", ""))
    odd = F.coalesce(marks / F.greatest(F.length(text), F.lit(1)), F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.least(F.lit(8.0), F.lit(8.0) * odd))


def uniform(*cols: Column, seed: int = 42) -> Column:
    """In (0, 1), from the md5 of the seed and the columns as text."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("?")) for c in cols]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, budget: float = 1.5, most: float = 2.0, pattern: tuple[float, ...] = PATTERN) -> DataFrame:
    """source, source_size, target from (source, source_size), one row a source; it sorts sources, not documents.

    Sources by code point, null last, weigh as the pattern, repeating.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, pattern)), (F.row_number().over(order) - 1) % len(pattern) + 1)
    rows = sizes.withColumn("w", w).withColumn("full", F.lit(most) * F.col("source_size") / F.col("w"))
    every = Window.partitionBy()
    upto = Window.orderBy("full", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("full", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("factor", (F.lit(budget) * F.sum("source_size").over(every) - F.lit(most) * F.coalesce(F.sum("source_size").over(upto), F.lit(0))) / F.sum("w").over(after))
    # each is the factor if all before are full and none from here on is; what the sources hold is concave in it, so the largest is right
    rows = rows.withColumn("factor", F.max("factor").over(every))
    return rows.select("source", "source_size", F.least(F.col("w") * F.col("factor"), F.lit(most) * F.col("source_size")).alias("target"))


SIZE, TIE, RANK = "__verdance_size", "__verdance_tie", "__verdance_key"


def _keyed(docs: DataFrame, weight: Column | None, seed: int) -> DataFrame:
    """docs with their size, tie-breaking hash and key, under names of their own."""
    docs = docs.withColumn(SIZE, size_of(F.col("text"))).withColumn(TIE, F.xxhash64("text"))
    q = weight if weight is not None else quality_of(F.col("text"), F.col(SIZE))
    # without an id, rows are told apart by their text
    who = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.concat(F.lit("?"), F.col(TIE)))
    return docs.withColumn(RANK, -F.ln(uniform(who, seed=seed)) / F.greatest(q.cast("double"), F.lit(1e-9)))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def plan(rows: DataFrame, budget: float = 1.5, most: float = 2.0, slices: int = SLICES, most_sorted: int = SORTED) -> DataFrame:
    """A row for each source of rows(doc_id, source, size, tie, key): its size, target, epochs, and what is taken of the rest.

    cut: the first (key, doc_id, tie) that the rest doesn't hold; close: the closing document.
    """
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), budget, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = materialize(goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")

    # the slice in which each source's rest ends: cut at quantiles, again and again, until it is small
    own = rows.where("size > 0")
    inside = own.join(goal.select(F.col("source").alias("__s"), F.lit(0).cast("long").alias("before"), "rest"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    sliced = own
    while True:
        at = F.percentile_approx("key", F.array(*[F.lit(i / slices) for i in range(1, slices)]), 10 * slices)
        cuts = inside.groupBy("source", "before", "rest").agg(F.when(F.count("*") > most_sorted, at).alias("cuts"), F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
        cuts = materialize(cuts, "mix-slices")
        # a row a source
        large = cuts.where((F.col("rows") > most_sorted) & (F.col("low") < F.col("high")))
        if large.isEmpty():
            break
        part = F.when(F.col("rows") > most_sorted, F.size(F.filter("cuts", lambda c: c < F.col("key")))).otherwise(0)
        placed = inside.alias("i").join(cuts.select(F.col("source").alias("__s"), "cuts", "rows"), F.col("i.source").eqNullSafe(F.col("__s"))).withColumn("slice", part).drop("__s", "cuts", "rows")
        running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        sums = placed.groupBy("source", "slice", "before", "rest").agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
        sums = sums.withColumn("from", F.col("before") + F.coalesce(F.sum("n").over(running), F.lit(0)))
        ends = materialize(sums.where("from <= rest and from + n > rest").select(F.col("source").alias("__s"), F.col("slice").alias("__slice"), "from"), "mix-ends")
        inside = placed.drop("before").join(ends, F.col("source").eqNullSafe(F.col("__s")) & (F.col("slice") == F.col("__slice"))).withColumnRenamed("from", "before").drop("__s", "__slice", "slice")
        inside = materialize(inside, "mix-inside")
        if inside.count() >= cuts.agg(F.sum("rows")).first()[0]:
            break
    # its rows in order: the first that would pass the rest
    inner = Window.partitionBy("source").orderBy("key", "doc_id", "tie")
    last = inside.withColumn("upto", F.col("before") + F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    cut = last.where("upto > rest").groupBy("source").agg(F.min(F.struct("key", "doc_id", "tie")).alias("cut"), F.min(F.struct("upto", "size")).alias("u"))
    cut = materialize(cut.alias("c").join(goal.alias("g"), _same("c", "g")).select("c.source", "cut", (F.col("rest") - (F.col("u.upto") - F.col("u.size"))).alias("left")), "mix-cuts")
    # the document from there on that fills what is left best; none if nothing does
    gap = F.abs(F.col("size") - F.col("left"))
    later = sliced.alias("r").join(cut.alias("c"), _same("r", "c")).where(F.struct("key", "doc_id", "tie") >= F.col("cut"))
    close = later.where(gap < F.abs(F.col("left"))).groupBy("r.source").agg(F.min(F.struct(gap.alias("gap"), "key", "doc_id", "tie")).alias("close"))
    cuts = cut.alias("c").join(close.alias("k"), _same("c", "k"), "left").select("c.source", "cut", F.struct("close.key", "close.doc_id", "close.tie").alias("close"))
    return materialize(goal.alias("g").join(cuts.alias("c"), _same("g", "c"), "left").select("g.*", "cut", "close"), "mix-plan")


def _takes(size: str, key: str, doc_id: str, tie: str) -> Column:
    """How often a document of `r` is taken by the plan `s` of its source."""
    own = F.struct(F.col(f"r.{key}").alias("key"), F.col(f"r.{doc_id}").cast("long").alias("doc_id"), F.col(f"r.{tie}").alias("tie"))
    fraction = F.when((own < F.col("s.cut")) | F.col("s.close.key").isNotNull() & own.eqNullSafe(F.col("s.close")), 1).otherwise(0)
    return F.when(F.col(f"r.{size}") > 0, F.col("s.epochs") + F.when(F.col("s.rest") > 0, fraction).otherwise(0)).otherwise(0).cast("int")


def _skinny(docs: DataFrame, weight: Column | None, seed: int) -> DataFrame:
    rows = _keyed(docs, weight, seed)
    return materialize(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col(SIZE).alias("size"), F.col(TIE).alias("tie"), F.col(RANK).alias("key")), "mix-sizes")


def mix(docs: DataFrame, weight: Column | None = None, budget: float = 1.5, most: float = 2.0, seed: int = 42, slices: int = SLICES, most_sorted: int = SORTED) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row.

    taken is size times 0 to `most` whole takes. A null text has size 0 and is never
    taken; a null source is a source; a source without words has target 0. Repeated
    rows are documents of their own; among equal keys the order is by id, then by text,
    and rows equal in all of these go together. Reruns agree. An empty table gives an empty one.
    """
    rows = _skinny(docs, weight, seed)
    joined = rows.alias("r").join(plan(rows, budget, most, slices, most_sorted).alias("s"), _same("r", "s"))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * _takes("size", "key", "doc_id", "tie")).alias("taken"))


def mixed(docs: DataFrame, weight: Column | None = None, budget: float = 1.5, most: float = 2.0, seed: int = 42, slices: int = SLICES, most_sorted: int = SORTED) -> DataFrame:
    """The rows of docs, all columns, as often as the mix takes them. Documents meet their source's plan alone, not their own row again."""
    state = plan(_skinny(docs, weight, seed), budget, most, slices, most_sorted)
    rows = _keyed(docs, weight, seed).alias("r").join(state.alias("s"), F.col("r.source").cast("string").eqNullSafe(F.col("s.source")))
    rows = rows.withColumn("__verdance_takes", _takes(SIZE, RANK, "doc_id", TIE)).where("__verdance_takes > 0")
    own = [F.col(f"r.`{c}`").alias(c) for c in docs.columns]
    return rows.select(*own, F.explode(F.sequence(F.lit(1), F.col("__verdance_takes"))).alias("__verdance_take")).drop("__verdance_take")
