"""Exact top-k inner products by best-first search of M-trees.

With M the largest norm of a tree's vectors, a vector x becomes x / M with the extra
component sqrt(1 - |x / M|^2), and a query q becomes q / |q| with the extra component 0;
then 2 - 2 q.x / (|q| M) is their squared distance, so the highest products are the
nearest points of a metric space. Vectors of about the same norm share a tree, so one
huge vector blunts no bound but its own tree's.

Rows are dealt over trees of bounded size. A tree's nodes are pages: a routing
vector, a covering radius, the distance to the parent's routing vector, and either
child nodes or entries with their distances to the routing vector. Queries descend in
rounds, each through its most promising nodes first. A node whose ball holds nothing
above the query's k-th score is never opened; the stored distances rule out children
and entries before any product with them is computed.

Bounds and products are doubles with a margin for their rounding; what remains is
scored in whole numbers of any size, so scores are exact. Equal query vectors are
searched once, and of equal vectors no more than k + 1 can be among a query's k best.
Queries go out in batches of bounded size; a batch meets a few trees first and takes
the k-th score found there along to many more, then to the rest.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdance.llm.common import map_batches, materialize
from verdance.llm.vectors import matrix, sound

PAGE, FANOUT = 96, 24
#: Bytes of a tree's vectors, and of the queries that are broadcast together, at most.
TREE_BYTES, BATCH_BYTES = 32 << 20, 64 << 20
#: Queries that go through a tree together.
QUERIES = 4096
#: Trees of a norm that the first pass takes; each next pass has as many times more.
PASS = 8
LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Tree:
    x: np.ndarray  # vectors by the largest norm
    a: np.ndarray  # their extra component
    router: np.ndarray  # of each node: its routing vector's row
    radius: np.ndarray
    parent: np.ndarray  # of each node: distance to the parent's routing vector
    children: list[np.ndarray]  # of each node: child nodes; of a page: none
    entries: list[np.ndarray]  # of a page: rows by distance to the routing vector
    away: list[np.ndarray]  # of a page: those distances

    @classmethod
    def build(cls, x: np.ndarray) -> Tree:
        """x: vectors of norms up to 1."""
        norm2 = (x * x).sum(axis=1)
        tree = cls(x, np.sqrt(np.maximum(1 - norm2, 0)), *[[] for _ in range(6)])
        if len(x):
            root = int(norm2.argmax())
            tree.add(np.arange(len(x)), root, tree.between(root, np.arange(len(x))), 0.0)
        tree.router, tree.radius, tree.parent = np.array(tree.router, np.int64), np.array(tree.radius), np.array(tree.parent)
        return tree

    def between(self, r: int, rows: np.ndarray) -> np.ndarray:
        d = self.x[rows] - self.x[r]
        return np.sqrt((d * d).sum(axis=1) + (self.a[rows] - self.a[r]) ** 2)

    def add(self, rows: np.ndarray, router: int, away: np.ndarray, parent: float) -> int:
        """Bulk-load a node over rows, whose distances to the router are away; returns its number."""
        k = len(self.router)
        self.router.append(router)
        self.radius.append(float(away.max()))
        self.parent.append(parent)
        self.children.append(np.empty(0, np.int64))
        self.entries.append(np.empty(0, np.int64))
        self.away.append(np.empty(0))
        if len(rows) <= PAGE:
            order = np.argsort(away, kind="stable")
            self.entries[k], self.away[k] = rows[order], away[order]
            return k
        n = min(FANOUT, -(-len(rows) // PAGE))
        # seeds spread over the distances from the router, itself the first
        seeds = np.unique(np.concatenate([[int(away.argmin())], np.argsort(away, kind="stable")[np.linspace(0, len(rows) - 1, n).astype(np.int64)]]))
        d = np.stack([self.between(int(rows[s]), rows) for s in seeds])
        nearest = d.argmin(axis=0)
        parts = [np.flatnonzero(nearest == i) for i in range(len(seeds))]
        if max(map(len, parts)) == len(rows):  # equal vectors: pages of any of them
            cuts = np.array_split(np.arange(len(rows)), n)
            self.children[k] = np.array([self.add(rows[c], router, away[c], 0.0) for c in cuts])
            return k
        kids = [self.add(rows[p], int(rows[s]), d[i][p], float(away[s])) for i, (p, s) in enumerate(zip(parts, seeds)) if len(p)]
        self.children[k] = np.array(kids)
        return k

    def search(self, q: np.ndarray, ids: np.ndarray, k: int, margin: float, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, vector row) of all that may be among a query's k best, ties to smaller ids.

        q: queries of length 1 (or 0). margin: twice what a product may be off; products
        under `least`, a bound by query, are left out.
        """
        none = np.empty(0, np.int64)
        best = (none, none, np.empty(0))
        if not len(self.x) or not len(q):
            return none, none
        q2 = (q * q).sum(axis=1)
        slack = 1e-9
        least = least - margin

        def reach(query: np.ndarray, distance: np.ndarray) -> np.ndarray:
            """The highest product with anything at this distance or more."""
            return (q2[query] + 1 - distance * distance) / 2 + slack

        def distance(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(q2[query][:, None] + 1 - 2 * (q[query] @ self.x[rows].T), 0))

        # open nodes: query, node, distance to its router, reach
        query = np.arange(len(q))
        away = distance(query, self.router[:1])[:, 0]
        node = np.zeros(len(q), np.int64)
        open_ = (query, node, away, reach(query, np.maximum(away - self.radius[0], 0)))
        at_once = 1
        while len(open_[0]):
            live = open_[3] >= least[open_[0]]
            query, node, away, high = (c[live] for c in open_)
            order = np.lexsort((-high, query))
            query, node, away, high = (c[order] for c in (query, node, away, high))
            first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else none
            rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
            now = rank < at_once
            later = tuple(c[~now] for c in (query, node, away, high))
            query, node, away = query[now], node[now], away[now]
            order = np.argsort(node, kind="stable")
            query, node, away = query[order], node[order], away[order]
            cuts = np.flatnonzero(np.r_[True, node[1:] != node[:-1], True]) if len(node) else none
            new, found = [later], [best]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                n, own_q, d = int(node[a]), query[a:b], away[a:b]
                # within this distance an object may still score
                wide = np.sqrt(np.maximum(q2[own_q] + 1 - 2 * (least[own_q] - slack), 0))
                if len(kids := self.children[n]):
                    near = np.abs(d[:, None] - self.parent[kids]) - self.radius[kids] <= wide[:, None] + 1e-9
                    kids, some = kids[near.any(axis=0)], near.any(axis=1)
                    if len(kids):
                        kd = distance(own_q[some], self.router[kids])
                        i, j = np.nonzero(near[some][:, near.any(axis=0)])
                        far = kd[i, j]
                        new.append((own_q[some][i], kids[j], far, reach(own_q[some][i], np.maximum(far - self.radius[kids[j]], 0))))
                    continue
                # entries lie by distance to the router: a stretch can be near enough
                lo, hi = np.searchsorted(self.away[n], (d - wide).min() - 1e-9), np.searchsorted(self.away[n], (d + wide).max() + 1e-9, side="right")
                rows = self.entries[n][lo:hi]
                if len(rows):
                    s = q[own_q] @ self.x[rows].T
                    i, j = np.nonzero(s >= least[own_q][:, None])
                    found.append((own_q[i], rows[j], s[i, j]))
            best = tuple(np.concatenate(c) for c in zip(*found))
            order = np.lexsort((ids[best[1]], -best[2], best[0]))
            best = tuple(c[order] for c in best)
            first = np.flatnonzero(np.r_[True, best[0][1:] != best[0][:-1]]) if len(best[0]) else none
            rank = np.arange(len(best[0])) - np.repeat(first, np.diff(np.r_[first, len(best[0])]))
            kth = rank == k - 1
            least[best[0][kth]] = np.maximum(least[best[0][kth]], best[2][kth] - margin)
            best = tuple(c[best[2] >= least[best[0]]] for c in best)
            open_ = tuple(np.concatenate(c) for c in zip(*new))
            at_once *= 2
        return best[0], best[1]


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows; squares neither vanish nor overflow."""
    top = np.abs(x).max(axis=1, initial=0)
    scale = np.where(top > 0, top, 1)
    return scale * np.sqrt(((x / scale[:, None]) ** 2).sum(axis=1))


def shrunk(x: np.ndarray, by: np.ndarray | float) -> np.ndarray:
    """Rows divided by lengths; zero rows stay."""
    by = np.broadcast_to(np.asarray(by, float), (len(x),))
    return x / np.where(by > 0, by, 1)[:, None]


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(64 x), as doubles, which hold it exactly; beyond their range the largest of them. No negative zeros."""
    top = np.finfo(float).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(64 * x), -top, top) + 0.0


def ordered(score: int) -> bytes:
    """For a score that 64 bits don't hold: bytes whose order is that of such scores; else none."""
    if LOW < score < HIGH:
        return b""
    n = (abs(score).bit_length() + 7) // 8
    body = n.to_bytes(4) + abs(score).to_bytes(n)
    return b"\1" + body if score > 0 else b"\0" + bytes(255 - b for b in body)


def exact(x: np.ndarray, q: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The whole-number products of q[i] with x[j], cut to 64 bits, and what tells larger ones apart."""
    score, more = np.empty(len(i), np.int64), [b""] * len(i)
    if not len(i):
        return score, more
    wide = np.abs(q).max(axis=1, initial=0)[i] * np.abs(x).max(axis=1, initial=0)[j] * x.shape[1] >= float(1 << 52)
    for a in range(0, len(i), 65_536):
        own = slice(a, a + 65_536)
        few = ~wide[own]
        score[own][few] = (q[i[own][few]] * x[j[own][few]]).sum(axis=1).astype(np.int64)
    for n in np.flatnonzero(wide).tolist():
        s = math.sumprod(list(map(int, q[i[n]].tolist())), list(map(int, x[j[n]].tolist())))
        score[n], more[n] = min(max(s, LOW), HIGH), ordered(s)
    return score, more


def _prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, dims, k1, k2, stratum, x: the scaled vectors, a digest by which equal ones are known, and half octaves of the norm."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col, n = batch.column("embedding"), batch.num_rows
        dims, key, stratum, x = np.asarray(col.value_lengths()), np.zeros((n, 2), "<i8"), np.zeros(n, np.int32), [None] * n
        for d in np.unique(dims).tolist():
            own = np.flatnonzero(dims == d)
            rows = np.ascontiguousarray(scaled(matrix(col.take(pa.array(own))))).reshape(len(own), d)
            size = norms(rows)
            stratum[own] = np.where(size > 0, np.floor(2 * np.log2(np.where(size > 0, size, 1))), -1)
            key[own] = np.frombuffer(b"".join(hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in rows), "<i8").reshape(-1, 2)
            for k, v in zip(own.tolist(), rows):
                x[k] = v
        cols = [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(stratum, pa.int32()), pa.array(x, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(cols, names=["vec_id", "dims", "k1", "k2", "stratum", "x"])

    return map_batches(sound(vectors), run, "vec_id long, dims int, k1 long, k2 long, stratum int, x array<double>")


def _rows(x: pd.Series, dims: int) -> np.ndarray:
    return np.stack(x.to_list()).astype(float) if len(x) and dims else np.zeros((len(x), dims))


FOUND = "k1 long, k2 long, dims int, vec_id long, score long, more binary"


def _search(trees: DataFrame, batch: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """What the trees hold for the queries of a batch: by length their keys, vectors and least scores."""
    shared = trees.sparkSession.sparkContext.broadcast(batch)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dims, out = int(key[0]), []
        if dims in shared.value:
            keys, q, least = shared.value[dims]
            pdf = pdf.sort_values("vec_id", ignore_index=True)
            x, ids = _rows(pdf["x"], dims), pdf["vec_id"].to_numpy()
            size = norms(x)
            top = float(size.max(initial=0)) or 1.0
            tree = Tree.build(shrunk(x, top))
            for a in range(0, len(q), QUERIES):
                own = q[a : a + QUERIES]
                length = norms(own)
                bound = least[a : a + QUERIES] / np.where(length > 0, length, 1) / top
                i, j = tree.search(shrunk(own, length), ids, k, 1e-12, bound - 1e-12)
                score, more = exact(x, own, i, j)
                part = pd.DataFrame({"k1": keys[a + i, 0], "k2": keys[a + i, 1], "dims": dims, "vec_id": ids[j], "score": score, "more": more, "i": i})
                part = part.sort_values(["i", "score", "more", "vec_id"], ascending=[True, False, False, True], kind="stable")
                out.append(part[part.groupby("i").cumcount() < k].drop(columns="i"))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")})

    return trees.groupBy("dims", "stratum", "tree").applyInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("k1", "k2", "dims").orderBy(F.desc("score"), F.desc("more"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _batch(rows: list, bounds: dict[tuple, float]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    out = {}
    for d in sorted({r["dims"] for r in rows}):
        own = [r for r in rows if r["dims"] == d]
        keys = np.array([(r["k1"], r["k2"]) for r in own], np.int64)
        out[d] = keys, np.array([r["x"] for r in own], float).reshape(len(own), d), np.array([bounds.get((r["k1"], r["k2"], d), -math.inf) for r in own])
    return out


def top_products(vectors: DataFrame, every: int = 20, k: int = 20, tree_bytes: int = TREE_BYTES, batch_bytes: int = BATCH_BYTES, trees_first: int = PASS) -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id divisible by `every`, the k highest products with the other vectors.

    Vectors that are null or hold null or non-finite components take no part, nor do
    null ids; repeated rows count once. Vectors of different lengths have no product;
    empty ones have product 0. Ties go to the smaller vec_id. Ranks are by the exact
    product; a product beyond 64 bits is returned as the nearest 64-bit number.

    The driver holds one batch of queries (batch_bytes) and, between passes, their k-th
    scores. A tree is built once a pass, from at most about tree_bytes.
    """
    rows = materialize(_prepared(vectors), "scaled-vectors")
    copies = Window.partitionBy("k1", "k2", "dims").orderBy("vec_id")
    kept = materialize(rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "candidates")
    sizes = kept.groupBy("dims", "stratum").count()
    total = max(1, kept.count())
    # trees of bounded bytes; of few rows still some, that run beside each other
    share = F.col("count") * F.lit(max(1.0, math.sqrt(total) / 32) / total)
    trees = F.greatest(F.lit(1), F.ceil(F.col("count") * 8 * F.col("dims") / F.lit(float(tree_bytes))), F.ceil(share)).cast("int")
    number = F.pmod(F.xxhash64(F.lit("tree"), "vec_id"), F.col("trees")).cast("int")
    # a few rows: one for each length and half octave
    dealt = kept.join(F.broadcast(sizes.withColumn("trees", trees).drop("count")), ["dims", "stratum"]).withColumn("tree", number)
    most = sizes.withColumn("trees", trees).agg(F.max("trees")).first()[0] or 1
    asks = rows.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    queries = materialize(asks.groupBy("k1", "k2", "dims").agg(F.min_by("x", "vec_id").alias("x")), "queries")
    batches = max(1, -(-(queries.agg(F.sum(F.col("dims") * 8 + 32)).first()[0] or 0) // batch_bytes))
    results = []
    for b in range(batches):
        # at most about batch_bytes
        asked = queries.where(F.pmod(F.xxhash64(F.lit("batch"), "k1", "k2"), F.lit(batches)) == b).collect()
        found, first, last, bounds = None, 0, trees_first, {}
        while True:
            part = _search(dealt.where((F.col("tree") >= first) & (F.col("tree") < last)), _batch(asked, bounds), k + 1)
            found = part if found is None else _best(found.unionByName(part), k + 1).drop("rank")
            if last >= most and batches == 1:
                break
            found = materialize(found, "found")
            if last >= most:
                break
            first, last = last, last * max(2, trees_first)
            bounds = {(r["k1"], r["k2"], r["dims"]): float(r["score"]) for r in _best(found, k + 1).where(F.col("rank") == k + 1).collect()}
        results.append(found)
    found = results[0]
    for part in results[1:]:
        found = found.unionByName(part)
    best = _best(found, k + 1).groupBy("k1", "k2", "dims").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))
    own = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = asks.select(F.col("vec_id").alias("query_id"), "k1", "k2", "dims").join(best, ["k1", "k2", "dims"]).select("query_id", F.posexplode(own).alias("i", "x"))
    return out.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
