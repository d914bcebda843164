"""SimHash near-duplicates by deletion variants of fingerprint segments.

Two fingerprints that differ in at most `bits` bits, cut into bits // 2 + 1 segments,
have a segment with at most one differing bit. So each fingerprint is indexed under
every segment with one bit left out: 64 variants in all. Equal variants bring
candidates together, and the whole fingerprints verify them. Equal fingerprints are
one class throughout, so copies are neither compared nor expanded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdance.llm.common import map_batches, materialize, text_bytes
from verdance.llm.components import components

#: Runs up to this long are compared pair by pair, longer ones by growing clusters.
SHORT = 16
#: Members of one variant that one task compares.
HOT = 65_536
COARSE = 65_536


def fingerprint(raw: bytes, k: int = 4, seed: int = 42) -> int:
    """Of UTF-8 text, as a signed 64-bit number. A bit is set if more than half of the k-word shingles' XXH64 have it."""
    words = raw.lower().split()  # bytes: A-Z alone, and the six ASCII white-space characters
    n = len(words)
    if not n:
        return 0
    text = b" ".join(words)
    if n <= k:
        hashes = [xxhash.xxh64_intdigest(text, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        first = np.concatenate([[0], ends[: n - k] + 1]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(text[a:b], seed) for a, b in zip(first, ends[k - 1 :].tolist())]
    h = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), 65_536):
        total += np.unpackbits(h[a : a + 65_536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fp of every row. Null and empty texts: 0."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = [fingerprint(t, k, seed) for t in batch.column("raw").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("raw")), run, "doc_id long, fp long")


def segments(bits: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    n = bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(fps: DataFrame, bits: int) -> DataFrame:
    """key, fp: for each bit, the number of the bit and its segment without it."""
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("b"))
    start = width = None
    for a, w in segments(bits):
        in_it = F.col("b").between(a, a + w - 1)
        start = F.when(in_it, a) if start is None else start.when(in_it, a)
        width = F.when(in_it, w) if width is None else width.when(in_it, w)
    rows = rows.select("fp", "b", start.alias("a"), width.alias("w"))
    part = F.expr("shiftrightunsigned(fp, a)").bitwiseAND(F.expr("shiftleft(1L, w) - 1L")).bitwiseAND(F.expr("~shiftleft(1L, b - a)"))
    return rows.select(F.expr("shiftleft(cast(b as long), 56)").bitwiseOR(part).alias("key"), "fp")


def _clusters(m: np.ndarray, bits: int) -> tuple[list, list]:
    """Links that span the clusters of m. Each found member leaves the rest, so a dense group costs about its size."""
    u, v, left = [], [], np.arange(len(m))
    while len(left):
        grow, left = [left[0]], left[1:]
        while grow and len(left):
            x = grow.pop()
            near = np.bitwise_count(m[left] ^ m[x]) <= bits
            if near.any():
                found = left[near]
                u += [m[x]] * len(found)
                v += m[found].tolist()
                grow += found.tolist()
                left = left[~near]
    return u, v


def _meets_first(diff: np.ndarray, bits: int) -> np.ndarray:
    """The first bit number under whose variant two fingerprints with this difference meet."""
    out = np.full(len(diff), 255, np.int64)
    for a, w in reversed(segments(bits)):
        own = (diff >> np.uint64(a)) & np.uint64((1 << w) - 1)
        n = np.bitwise_count(own)
        at = np.log2(np.where(n == 1, own, 1).astype(float)).astype(np.int64)
        out = np.where(n == 0, a, np.where(n == 1, a + at, out))
    return out


def near_in_runs(key: np.ndarray, fp: np.ndarray, bits: int, tagged: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Links among equal keys; rows are sorted by key. In short runs a pair is linked under its first common variant alone."""
    fp = fp.view(np.uint64)
    cut = np.flatnonzero(np.diff(key)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
    length = np.repeat(last - first, last - first)
    us, vs = [], []
    for d in range(1, SHORT):
        i = np.flatnonzero((key[:-d] == key[d:]) & (length[:-d] <= SHORT)) if d < len(key) else np.empty(0, np.int64)
        if not len(i):
            break
        diff = fp[i] ^ fp[i + d]
        near = np.bitwise_count(diff) <= bits
        if tagged:
            near &= _meets_first(diff, bits) == (key[i] >> 56)
        us.append(fp[i[near]])
        vs.append(fp[i[near] + d])
    for a, b in zip(first[last - first > SHORT].tolist(), last[last - first > SHORT].tolist()):
        u, v = _clusters(fp[a:b], bits)
        us.append(np.array(u, np.uint64))
        vs.append(np.array(v, np.uint64))
    join = lambda x: np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64)
    return join(us), join(vs)


def _compare(rows: DataFrame, bits: int, by: list[str], tagged: bool) -> DataFrame:
    """Links among the rows that agree in `by`, which one partition holds sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_key = kept_fp = np.empty(0, np.int64)

        def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            u, v = near_in_runs(key, fp, bits, tagged)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            key = np.concatenate([kept_key, batch.column("key").to_numpy()])
            fp = np.concatenate([kept_fp, batch.column("fp").to_numpy()])
            # the last run may go on in the next batch
            at = int(np.searchsorted(key, key[-1])) if (np.diff(key) >= 0).all() else 0
            if at:
                yield links(key[:at], fp[:at])
            kept_key, kept_fp = key[at:], fp[at:]
        if len(kept_key):
            yield links(kept_key, kept_fp)

    dealt = rows.repartition(*by).sortWithinPartitions(*by, "fp")
    return dealt.select("key", "fp").mapInArrow(run, "u long, v long")


def links(classes: DataFrame, bits: int = 4, hot: int = HOT) -> DataFrame:
    """Links (u, v) between distinct fingerprints; they connect all that differ in at most `bits` bits.

    A variant with more than `hot` members is split into blocks, and each pair of
    blocks is compared in a group of its own: no task holds more than two blocks.
    """
    rows = variants(classes, bits)
    # a coarse count first: its partial sums are small, and rarely does anything need the fine one
    coarse = F.pmod(F.hash("key"), F.lit(COARSE))
    full = rows.groupBy(coarse.alias("c")).count().where(F.col("count") > hot).select("c")
    if full.isEmpty():
        return _compare(rows, bits, ["key"], True)
    large = materialize(rows.withColumn("c", coarse).join(full, "c").groupBy("key").count().where(F.col("count") > hot).select("key", F.ceil(F.col("count") / hot).cast("int").alias("s")), "hot-variants")
    if large.isEmpty():
        return _compare(rows, bits, ["key"], True)
    block = F.pmod(F.xxhash64("fp"), F.col("s")).cast("int")
    pairs = rows.join(large, "key").withColumn("i", block).select("key", "fp", "i", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("j"))
    group = F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j"))
    blocks = pairs.select(group.alias("key"), "fp").distinct()
    return _compare(rows.join(large, "key", "left_anti"), bits, ["key"], True).unionByName(_compare(blocks, bits, ["key"], False))


def near_duplicates(docs: DataFrame, bits: int = 4, k: int = 4, seed: int = 42, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    Documents without words have fingerprint zero and link like any other. Repeated
    rows are members of one class. component_id: smallest doc_id reachable; null ids
    count as none, so a component of null ids alone has a null id.
    """
    fps, of = classes_of(docs, bits, k, seed, hot)
    return fps.join(of.select("fp", "component_id"), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def classes_of(docs: DataFrame, bits: int = 4, k: int = 4, seed: int = 42, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """doc_id, fp of every row; and fp, rep (its smallest id), component_id, stays of every fingerprint.

    stays: of each component the fingerprint with the smallest id, of these the smallest; null ids come last.
    """
    fps = materialize(fingerprints(docs, k, seed), "fingerprints")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(links(classes.select("fp"), bits, hot))
    linked = materialize(classes.join(roots.withColumnRenamed("node", "fp"), "fp"), "linked")
    # a row a component, written: a large component's rows are then split in the join
    first = F.min(F.struct(F.col("rep").isNull(), "rep", "fp")).alias("s")
    least = materialize(linked.groupBy("root").agg(first).select("root", F.col("s.rep").alias("component_id"), F.col("s.fp").alias("first")), "components")
    of = linked.join(least, "root").select("fp", "component_id", (F.col("fp") == F.col("first")).alias("stays"))
    of = classes.join(materialize(of, "member-of").withColumn("linked", F.lit(True)), "fp", "left")
    return fps, materialize(of.select("fp", "rep", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("rep")).alias("component_id"), F.coalesce("stays", F.lit(True)).alias("stays")), "classes")


def keep_one(docs: DataFrame, bits: int = 4, k: int = 4, seed: int = 42) -> DataFrame:
    """The rows of docs, all columns, with one document of each component: the smallest id, of it the smallest fingerprint.

    A component of null ids alone keeps its smallest fingerprint. Only what goes is joined
    to the documents: by id where each row has its own, else by id and fingerprint.
    """
    fps, of = classes_of(docs, bits, k, seed)
    stays = of.where("stays").select("fp", "rep")
    rows = fps.groupBy("doc_id", "fp").count()
    rows = rows.join(stays, "fp", "left").select("doc_id", "fp", "count", (F.col("doc_id").eqNullSafe(F.col("rep")) & stays["fp"].isNotNull()).alias("stays"))
    rows = materialize(rows, "simhash-groups")
    shared = rows.where("doc_id is not null").groupBy("doc_id").agg(F.sum("count").alias("n")).where("n > 1").select(F.col("doc_id").alias("__id"))
    gone = rows.where("not stays").select(F.col("doc_id").alias("__gone"), F.col("fp").alias("__of"))
    alone = docs.where("doc_id is not null").join(shared, docs["doc_id"] == F.col("__id"), "left_anti")
    alone = alone.join(gone.select("__gone").distinct(), docs["doc_id"] == F.col("__gone"), "left_anti")
    if rows.where("doc_id is null").isEmpty() and shared.isEmpty():
        return alone
    odd = docs.where("doc_id is null").unionByName(docs.where("doc_id is not null").join(shared, docs["doc_id"] == F.col("__id"), "left_semi"))
    odd = with_fingerprint(odd, k, seed)
    odd = odd.join(gone, odd["doc_id"].cast("long").eqNullSafe(F.col("__gone")) & (odd["__fp"] == F.col("__of")), "left_anti")
    return alone.unionByName(odd.dropDuplicates(["doc_id", "__fp"]).drop("__fp"))


def with_fingerprint(docs: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """docs, with the text's fingerprint as __fp."""
    names = docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = [fingerprint(t, k, seed) for t in batch.column("__raw").to_pylist()]
        return pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(fp, pa.int64())], names=[*names, "__fp"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    return map_batches(docs.withColumn("__raw", text_bytes()), run, schema)
