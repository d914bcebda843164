"""Embedding near-duplicates by collision counting on sorted one-dimensional projections.

Unit vectors, less the mean of all, are projected on many random directions. Each
vector enters the sorted lists of its most extreme projections (by direction and
sign), so a mean that all share fills no list. In each list the
window centred on a vector holds its collisions; a pair is a candidate if its
collisions over all lists reach the count that pairs at the threshold reach with the
wanted probability. The law of two projections depends on the cosine of what is left
of the vectors alone, so window and count are calibrated by simulation: for the least
such cosine of a pair at the threshold, which the lengths that are left give. A list
is cut into cells of the window's width, and only equal and adjacent cells meet.

Dense groups go by representatives. A vector is compared with those that are the first,
by hash, of several of its lists; within half the threshold's angle it is in the ball of
one, and any two of a ball are links by the triangle inequality. A ball enters a
list once, with the range of its members. Candidates are pairs of balls: the angle
between representatives and the radii decide for all members at once, else members
are compared with the other representative, else with each other. Links are counted,
not listed; only one link for each pair of balls goes on to the components.

The number of directions grows with the 0.6th power of the rows, so the length of a
list, and with it the work, grows more slowly than the pairs do. Directions are made in
blocks and not kept.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import map_batches, materialize
from verdance.llm.components import components
from verdance.llm.vectors import matrix, sound

SEED = 20240229
#: Directions made at once, and vectors projected on them at once.
BLOCK, ROWS = 1024, 4096
#: Numbers of lists that a vector may enter; the first that calibrates is taken.
ENTRIES = (14, 17, 20, 24, 28, 34, 40, 48, 57, 68, 80, 96, 114, 136, 160, 192, 226, 270, 320)
#: Collisions that a candidate must have, at least, if the entries allow it.
LEAST = 2
#: Lists that vectors without likeness share on average, for which the directions are doubled up to three times.
CHANCE = 0.2
#: Angles are compared with this margin; between, cosines decide.
MARGIN = 1e-7


def directions(dims: int, block: int, n: int = BLOCK, seed: int = SEED) -> np.ndarray:
    """One block of n random directions of equal length, as columns: so no list is favoured."""
    g = np.random.default_rng([seed, dims, block]).standard_normal((dims, n), np.float32)
    return g * (math.sqrt(dims) / np.sqrt((g * g).sum(axis=0)))


def entries(w: np.ndarray, m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For vectors of length 1: the lists (2 x direction + sign) of their n most extreme of m projections, most extreme first, and the values there."""
    w = w.astype(np.float32)
    value, lists = np.empty((len(w), 0), np.float32), np.empty((len(w), 0), np.int64)
    for block in range(-(-m // BLOCK)):
        p = w @ directions(w.shape[1], block, min(BLOCK, m - block * BLOCK))
        size = np.abs(p)
        keep = min(n, size.shape[1])
        at = np.argpartition(-size, keep - 1, axis=1)[:, :keep]
        new = np.take_along_axis(size, at, axis=1)
        value = np.concatenate([value, new], axis=1)
        lists = np.concatenate([lists, 2 * (at + block * BLOCK) + (np.take_along_axis(p, at, axis=1) < 0)], axis=1)
        if value.shape[1] > n:
            at = np.argpartition(-value, n - 1, axis=1)[:, :n]
            value, lists = np.take_along_axis(value, at, axis=1), np.take_along_axis(lists, at, axis=1)
    order = np.lexsort((lists, -value), axis=1)
    return np.take_along_axis(lists, order, axis=1), np.take_along_axis(value, order, axis=1)


@lru_cache(64)
def calibrate(cosine: float, m: int, dims: int = 64, recall: float = 0.995, trials: int = 400, seed: int = SEED) -> tuple[int, float, int]:
    """(entries, window, count): lists that a vector enters, half the width of a window, and the collisions that pairs at this cosine reach with the wanted probability.

    Simulated in the plane of the pair, as projections depend on nothing else. The
    window holds 99.5 % of the differences of such pairs in common lists. Of the numbers
    of entries, the least that brings enough collisions is taken, found by halving.
    """

    def simulate(n: int) -> tuple[int, float, int]:
        rng, gaps, free = np.random.default_rng([seed, m, n]), [], max(dims - 2, 1)
        for _ in range(trials):
            x, y, z = rng.standard_normal((3, m), np.float32)
            # the rest of a direction's length: chi-square by its cube root
            rest = free * (1 - 2 / (9 * free) + z * math.sqrt(2 / (9 * free))) ** 3 if dims > 2 else 0
            length = np.sqrt((x * x + y * y + rest) / dims)
            x, y = x / length, (cosine * x + math.sqrt(1 - cosine * cosine) * y) / length
            a, b = np.argpartition(-np.abs(x), n - 1)[:n], np.argpartition(-np.abs(y), n - 1)[:n]
            both = np.intersect1d(a, b, assume_unique=True)
            gaps.append(np.abs(x[both] - y[both])[np.sign(x[both]) == np.sign(y[both])])
        every = np.concatenate(gaps)
        width = float(np.quantile(every, 0.995)) if every.size else math.inf
        return n, width, int(np.sort([(g <= width).sum() for g in gaps])[int((1 - recall) * trials)])

    ladder = [n for n in ENTRIES if n <= m]
    low, high, best = 0, len(ladder) - 1, simulate(ladder[-1])
    while low < high:
        middle = min((low + high) // 2, low + 2)  # most need few
        got = simulate(ladder[middle])
        if got[2] >= LEAST:
            high, best = middle, got
        else:
            low = middle + 1
    return best[0], best[1], max(1, best[2])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; lengths are scaled first, so that squares neither vanish nor overflow."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def angles(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def units(column: pa.ListArray) -> np.ndarray:
    x = matrix(column)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_dims(column: pa.ListArray, rows: int = ROWS):
    """(dims, positions) of the vectors of equal length, some at a time."""
    dims = np.asarray(column.value_lengths())
    for d in np.unique(dims).tolist():
        own = np.flatnonzero(dims == d)
        for a in range(0, len(own), rows):
            yield d, own[a : a + rows]


def pair_cosines(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """Of two list columns, row by row; 0 where the lengths differ."""
    out, ok = np.zeros(len(a)), np.asarray(a.value_lengths()) == np.asarray(b.value_lengths())
    for _, own in by_dims(a):
        own = own[ok[own]]
        if len(own):
            at = pa.array(own)
            out[own] = cosines(matrix(a.take(at)), matrix(b.take(at)))
    return out


def keyed(rows: DataFrame) -> DataFrame:
    """rows(vec_id, embedding) with a 128-bit digest of the embedding (k1, k2), by which equal vectors are known."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col, out = batch.column("embedding"), np.zeros((batch.num_rows, 2), "<i8")
        for d, own in by_dims(col):
            x = np.ascontiguousarray(matrix(col.take(pa.array(own))) + 0.0)  # no negative zeros
            out[own] = np.frombuffer(b"".join(hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in x), "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), col, pa.array(out[:, 0]), pa.array(out[:, 1])], names=["vec_id", "embedding", "k1", "k2"])

    return map_batches(rows.select("vec_id", "embedding"), run, "vec_id long, embedding array<double>, k1 long, k2 long")


def centres(classes: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Vectors and the mean of the unit vectors, by length: one row a batch, then one for each component."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims, n, total = [], [], []
        for d, own in by_dims(batch.column("embedding")):
            dims.append(d)
            n.append(len(own))
            total.append(units(batch.column("embedding").take(pa.array(own))).sum(axis=0).tolist())
        return pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.float64()))], names=["dims", "n", "total"])

    parts = map_batches(classes.select("embedding"), run, "dims int, n long, total array<double>")
    got = parts.select("dims", "n", F.posexplode("total").alias("i", "x")).groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in sorted(got, key=lambda r: (r["dims"], r["i"])):
        n, mean = out.setdefault(r["dims"], (r["n"], np.zeros(r["dims"])))
        mean[r["i"]] = r["x"] / n
    return out


def residuals(x: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the mean leaves of unit vectors, at length 1, and the squares of its lengths."""
    w = x - mean
    r2 = (w * w).sum(axis=1)
    return w / np.sqrt(np.maximum(r2, 1e-24))[:, None], r2


def least_cosine(classes: DataFrame, means: dict[int, tuple[int, np.ndarray]], threshold: float, share: float = 0.002) -> float:
    """The cosine, of what the means leave, of a pair at the threshold whose lengths are the smallest but for a share of the vectors."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = np.empty(batch.num_rows)
        for d, own in by_dims(batch.column("embedding")):
            out[own] = residuals(units(batch.column("embedding").take(pa.array(own))), means[d][1])[1]
        return pa.RecordBatch.from_arrays([pa.array(out)], names=["r2"])

    if not means:
        return threshold
    low = map_batches(classes.select("embedding"), run, "r2 double").agg(F.percentile_approx("r2", share, 10_000)).first()[0]
    # in steps, so that calibrations agree between near-equal tables
    return min(round(threshold, 3), max(0.25, math.floor(100 * (1 - (1 - threshold) / max(low, 1e-9))) / 100))


def project(classes: DataFrame, means: dict[int, tuple[int, np.ndarray]], m: int, settings: dict[int, tuple[int, float, int]]) -> DataFrame:
    """dims, list, x, id: the entries of every vector; x is in windows. settings: (entries, window, count) by bucket of the length."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, col = batch.column("id").to_numpy(), batch.column("embedding")
        out: list[list[np.ndarray]] = [[], [], [], []]
        for d, own in by_dims(col):
            n, window, _ = settings[bucket(d)]
            lists, value = entries(residuals(units(col.take(pa.array(own))), means[d][1])[0], m, n)
            for c, part in zip(out, (np.full(lists.size, d), lists.ravel(), value.ravel() / window, np.repeat(ids[own], lists.shape[1]))):
                c.append(part)
        cols = [pa.array(np.concatenate(c), t) for c, t in zip(out, (pa.int32(), pa.int32(), pa.float32(), pa.int64()))]
        return pa.RecordBatch.from_arrays(cols, names=["dims", "list", "x", "id"])

    return map_batches(classes.select("id", "embedding"), run, "dims int, list int, x float, id long")


def bucket(dims: int) -> int:
    """Vectors of about the same length are calibrated together."""
    return dims.bit_length()


def needed(dims: Column, settings: dict[int, tuple[int, float, int]]) -> Column:
    """The collisions that a candidate must have."""
    return F.element_at(F.create_map(*[F.lit(x) for k, (_, _, count) in settings.items() for x in (k, count)]), F.length(F.bin(dims)))


def balls(classes: DataFrame, held: DataFrame, threshold: float, settings: dict[int, tuple[int, float, int]]) -> DataFrame:
    """id, ball, angle of the vectors that lie in the ball of a representative other than themselves, and the angle between.

    A list's first is the one whose hash is the least, so members of a dense group,
    who share most of their lists, find the same first there. It is a representative if
    it lies in no other's ball.
    """
    half = math.acos(threshold) / 2 - MARGIN
    order = lambda c: F.struct(F.xxhash64(F.lit("first"), c), c)
    first = held.groupBy("dims", "list").agg(F.min(order("id"))["id"].alias("ball"), F.count("*").alias("n")).where("n > 1").select("dims", "list", "ball")
    own = held.join(first, ["dims", "list"]).where("id <> ball").groupBy("id", "ball", "dims").agg(F.count("*").alias("n")).where(F.col("n") > needed(F.col("dims"), settings)).select("id", "ball")
    own = own.join(classes.select("id", "embedding"), "id").join(classes.select(F.col("id").alias("ball"), F.col("embedding").alias("of")), "ball")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        angle = angles(pair_cosines(batch.column("embedding"), batch.column("of")))
        rows = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ball"), pa.array(angle)], names=["id", "ball", "angle"])
        return rows.filter(pa.array(angle <= half))

    near = materialize(map_batches(own.select("id", "ball", "embedding", "of"), run, "id long, ball long, angle double"), "near-firsts")
    rank = lambda c: F.xxhash64(F.lit("first"), c)
    under = near.where(F.struct(rank("ball"), "ball") < F.struct(rank("id"), "id"))
    free = under.join(under.select(F.col("id").alias("ball")).distinct(), "ball", "left_anti")
    return free.groupBy("id").agg(F.min(F.struct(rank("ball"), "ball", "angle")).alias("s")).select("id", "s.ball", "s.angle")


def _decide(pairs: DataFrame, threshold: float, keep: list[str]) -> DataFrame:
    """pairs(ea, ra, eb, rb, ...) as keep and `all`: true if all members of the one are links of all of the other, null if that is open; pairs without links go."""
    limit = math.acos(threshold)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cos = pair_cosines(batch.column("ea"), batch.column("eb"))
        angle, reach = angles(cos), batch.column("ra").to_numpy() + batch.column("rb").to_numpy()
        single = reach == 0
        every = np.where(single, cos >= threshold, angle + reach <= limit - MARGIN)
        some = np.where(single, every, angle - reach <= limit + MARGIN)
        rows = pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(every, mask=~every)], names=[*keep, "all"])
        return rows.filter(pa.array(some))

    kinds = dict(pairs.dtypes)
    return map_batches(pairs.select(*dict.fromkeys([*keep, "ea", "ra", "eb", "rb"])), run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", all boolean")


def meetings(spans: DataFrame, settings: dict[int, tuple[int, float, int]]) -> DataFrame:
    """(a, b), a < b: the balls that collide on enough lists of spans(dims, list, ball, lo, hi), lo and hi in windows.

    Each list is cut into cells of the window's width; a ball's cells meet the other's
    cells and the ones beside them, and a pair counts in the first cell where it meets.
    """
    rows = spans.withColumns({"c0": F.floor("lo").cast("int"), "c1": F.floor("hi").cast("int")})
    a = rows.select("dims", "list", F.explode(F.sequence("c0", "c1")).alias("c"), F.col("ball").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), F.col("c0").alias("ac"))
    b = rows.select("dims", "list", F.explode(F.sequence(F.col("c0") - 1, F.col("c1") + 1)).alias("c"), F.col("ball").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), (F.col("c0") - 1).alias("bc"))
    near = (F.col("alo") - 1 <= F.col("bhi")) & (F.col("blo") - 1 <= F.col("ahi"))
    met = a.join(b, ["dims", "list", "c"]).where((F.col("a") < F.col("b")) & (F.col("c") == F.greatest("ac", "bc")) & near)
    return met.groupBy("a", "b", "dims").agg(F.count("*").alias("n")).where(F.col("n") >= needed(F.col("dims"), settings)).select("a", "b")


def links(classes: DataFrame, threshold: float = 0.9, recall: float = 0.995) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of classes(id, n, embedding), n vectors each: (id, ball, n), (a, b) between balls with a link, and (id, more) and the ball's (null id) more.

    The links of a vector are its ball's n but itself, and what `more` adds for it and for its ball.
    """
    means = centres(classes)
    m = BLOCK * max(1, math.ceil(max((n for n, _ in means.values()), default=1) ** 0.6 / 32))
    cosine = least_cosine(classes, means, threshold)
    for m in (m << k for k in range(4)):
        settings = {bucket(d): calibrate(cosine, m, 1 << bucket(d) >> 1, recall) for d in means} or {0: (1, 1.0, 1)}
        # lists that two vectors without likeness share, on average: more directions where pairs are hard to tell
        if max(n * n / (2 * m) for n, _, _ in settings.values()) <= CHANCE:
            break
    held = materialize(project(classes, means, m, settings), "projections")
    near = materialize(balls(classes, held, threshold, settings), "balls")

    grouped = held.join(near.select("id", "ball"), "id", "left").groupBy("dims", "list", F.coalesce("ball", "id").alias("ball")).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    pairs = materialize(meetings(grouped, settings), "candidates")

    members = materialize(classes.select("id", "n").join(near, "id", "left").select("id", F.coalesce("ball", "id").alias("ball"), F.coalesce("angle", F.lit(0.0)).alias("angle"), "n"), "members")
    state = members.groupBy("ball").agg(F.max("angle").alias("r"), F.sum("n").alias("n"))
    state = materialize(state.join(classes.select(F.col("id").alias("ball"), F.col("embedding").alias("e")), "ball"), "representatives")
    side = lambda s: state.select(F.col("ball").alias(s), F.col("e").alias(f"e{s}"), F.col("r").alias(f"r{s}"), F.col("n").alias(f"n{s}"))
    first = materialize(_decide(pairs.join(side("a"), "a").join(side("b"), "b"), threshold, ["a", "b", "ra", "rb", "na", "nb"]), "ball-pairs")
    whole = first.where("all")
    none = F.lit(None).cast("long")
    more = [whole.select(none.alias("id"), F.col(x).alias("ball"), F.col(f"n{y}").alias("more")) for x, y in ("ab", "ba")]
    edges = whole.select("a", "b")
    open_ = first.where("all is null")
    if not open_.isEmpty():
        vectors = classes.select("id", "embedding")
        # the members of the ball with the larger radius against the other's representative
        turned = open_.select(*[F.when(F.col("ra") >= F.col("rb"), F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("a", "b", "a"), ("b", "a", "b"), ("nb", "na", "nb"), ("rb", "ra", "rb"))])
        one = turned.join(members.select(F.col("ball").alias("a"), F.col("id").alias("u"), F.col("n").alias("nu")), "a").join(vectors.select(F.col("id").alias("u"), F.col("embedding").alias("ea")), "u").withColumn("ra", F.lit(0.0))
        second = materialize(_decide(one.join(side("b").select("b", "eb"), "b"), threshold, ["u", "nu", "a", "b", "nb", "rb"]), "member-pairs")
        sure = second.where("all")
        more += [sure.select(F.col("u").alias("id"), F.col("a").alias("ball"), F.col("nb").alias("more")), sure.select(none.alias("id"), F.col("b").alias("ball"), F.col("nu").alias("more"))]
        rest = second.where("all is null").join(members.select(F.col("ball").alias("b"), F.col("id").alias("v"), F.col("n").alias("nv")), "b")
        rest = rest.join(vectors.select(F.col("id").alias("u"), F.col("embedding").alias("ea")), "u").join(vectors.select(F.col("id").alias("v"), F.col("embedding").alias("eb")), "v").withColumns({"ra": F.lit(0.0), "rb": F.lit(0.0)})
        third = materialize(_decide(rest, threshold, ["u", "nu", "a", "v", "nv", "b"]), "links")
        more += [third.select(F.col("u").alias("id"), F.col("a").alias("ball"), F.col("nv").alias("more")), third.select(F.col("v").alias("id"), F.col("b").alias("ball"), F.col("nu").alias("more"))]
        edges = edges.unionByName(sure.select("a", "b")).unionByName(third.select("a", "b"))
    every = more[0]
    for part in more[1:]:
        every = every.unionByName(part)
    return members.select("id", "ball", "n"), edges.distinct(), every.groupBy("ball", "id").agg(F.sum("more").alias("more"))


def digest_is(a: str, b: str) -> Column:
    return (F.col(f"{a}.k1") == F.col(f"{b}.k1")) & (F.col(f"{a}.k2") == F.col(f"{b}.k2"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.995) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Equal vectors are one class, linked among themselves without comparison. Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing,
    nor do vectors of different lengths. Rows that repeat an id count as one vector;
    a null id has no links, a null component and is not kept. Recall is calibrated at
    the threshold; the few vectors that lie nearest to the mean of all may have less.
    """
    rows = materialize(keyed(sound(vectors).where(F.exists("embedding", lambda x: x != 0))), "vectors")
    classes = rows.groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.min_by("embedding", "vec_id").alias("embedding"))
    classes = materialize(classes, "vector-classes")
    members, edges, more = links(classes.select("id", "n", "embedding"), threshold, recall)
    more = materialize(more, "link-counts")
    roots = components(edges.toDF("u", "v")).withColumnRenamed("node", "ball")
    size = members.groupBy("ball").agg(F.sum("n").alias("n"), F.min("id").alias("least"))
    size = size.join(more.where("id is null").select("ball", "more"), "ball", "left").join(roots, "ball", "left")
    size = size.select("ball", (F.col("n") + F.coalesce("more", F.lit(0)) - 1).alias("links"), "least", F.coalesce("root", "ball").alias("root"))
    least = size.groupBy("root").agg(F.min("least").alias("component"))
    size = size.join(least, "root").select("ball", "links", "component")
    state = members.join(size, "ball").join(more.where("id is not null").select("id", "more"), "id", "left")
    state = state.select("id", (F.col("links") + F.coalesce("more", F.lit(0))).cast("long").alias("links"), "component")
    state = materialize(classes.select("id", "k1", "k2").join(state, "id").select("k1", "k2", "links", "component"), "vector-state")
    # a class may hold many rows: they are joined to it by its digest, not gathered
    member = rows.select("vec_id", "k1", "k2").alias("r").join(state.alias("s"), digest_is("r", "s")).select(F.col("vec_id").alias("member"), "links", "component")
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(member, F.col("vec_id") == F.col("member"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
