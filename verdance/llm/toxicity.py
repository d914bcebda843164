"""Toxic passages by maximum-scoring segments of token log-odds.

Fitting counts, over a bounded sample of labelled documents, in how many toxic and
clean documents each unit occurs: words, and their prefixes of 4 to 7 letters, as
inflected words are rare one by one. A unit's toxic share has a Dirichlet prior at
the share of the next shorter unit, so a rare unit keeps what its stem shows. Its
log-odds against the base rate, less a drift that makes plain text lose, score a token.

A linear scan finds all maximal scoring segments of a text. By extreme-value theory
the chance that plain text of n tokens has a segment of score S or more is
1 - exp(-K n exp(-lambda S)); lambda solves sum p(s) exp(lambda s) = 1 over the token
scores of clean documents, and K is set on their largest segments. Segments under the
chance `significance` are toxic passages. A logistic curve over the normalised score and
the number of passages, fitted on the half of the sample that the counts have not seen,
gives the document's score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import fold_of, labelled_sample, map_batches, materialize

TOKENS = re.compile(r"[^\W\d_]+").findall
STEMS = (4, 5, 6, 7)
CACHE = 150_000


@dataclass
class ToxicModel:
    #: Unit to score: words as they are, stems with a trailing "*".
    units: dict[str, float]
    rest: float
    lam: float = 1.0
    k: float = 0.1
    significance: float = 0.05
    weights: tuple[float, float, float] = (-3.0, 0.3, 0.5)
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def token(self, word: str) -> float:
        if (s := self.units.get(word)) is not None:
            return s
        for n in reversed(STEMS):
            if len(word) > n and (s := self.units.get(word[:n] + "*")) is not None:
                return s
        return self.rest

    def chunk(self, chunk: str) -> float:
        """Score of a run without white space: of its words together."""
        known = sum(map(self.token, TOKENS(chunk)))
        if len(self.cache) >= CACHE:
            self.cache.clear()
        if len(chunk) <= 64:
            self.cache[chunk] = known
        return known

    def scores(self, text: str | None) -> list[float]:
        """Of each run without white space. The k-th time that a text has the same run, it counts for a k-th: repeats are no new evidence."""
        get, chunks = self.cache.get, (text or "").lower().split()
        out = [s if (s := get(c)) is not None else self.chunk(c) for c in chunks]
        seen: dict[str, int] = {}
        for i in [i for i, s in enumerate(out) if s > 0]:
            k = seen[chunks[i]] = seen.get(chunks[i], 0) + 1
            out[i] = self.rest + (out[i] - self.rest) / k
        return out

    def chance(self, score: float, n: int) -> float:
        """That plain text of n tokens has a segment of this score or more."""
        return -math.expm1(-min(700.0, self.k * max(n, 1) * math.exp(-self.lam * score)))

    def passages(self, text: str | None) -> list[tuple[int, int, float, float]]:
        """Significant segments of the text: first and last run of non-space characters, score, chance."""
        scores = self.scores(text)
        out = [(a, b, s, self.chance(s, len(scores))) for a, b, s in maximal_segments(scores)]
        return [x for x in out if x[3] <= self.significance]

    def features(self, scores: list[float]) -> tuple[int, float, int]:
        """Tokens, largest segment's score, number of significant segments."""
        n = len(scores)
        segments = [s for _, _, s in maximal_segments(scores)]
        return n, max(segments, default=0.0), sum(self.chance(s, n) <= self.significance for s in segments)

    def score(self, n: np.ndarray, top: np.ndarray, passages: np.ndarray) -> np.ndarray:
        w = self.weights
        return 1 / (1 + np.exp(-np.clip(w[0] + w[1] * self.normal(n, top) + w[2] * np.log1p(passages), -40, 40)))

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
        """Score and significant segments of each text."""
        n, top, spans = [], [], []
        for text in texts:
            scores = self.scores(text)
            segments = maximal_segments(scores)
            n.append(len(scores))
            top.append(max((s for _, _, s in segments), default=0.0))
            found = [(a, b, self.chance(s, len(scores))) for a, b, s in segments]
            spans.append([{"first": a, "last": b, "chance": p} for a, b, p in found if p <= self.significance])
        return self.score(np.asarray(n, float), np.asarray(top, float), np.asarray([min(len(x), 1) for x in spans])), spans

    def normal(self, n: np.ndarray, top: np.ndarray) -> np.ndarray:
        return np.clip(self.lam * top - np.log(self.k * np.maximum(n, 1)), -10, 15)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in one pass."""
    total = 0.0
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before it, sum up to it
    for i, s in enumerate(scores):
        if s > 0:
            first, before, after = i, total, total + s
            while True:
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= before:
                    j -= 1
                if j < 0 or stack[j][3] >= after:
                    stack.append((first, i, before, after))
                    break
                first, before = stack[j][0], stack[j][2]
                del stack[j:]
        total += s
    return [(a, b, y - x) for a, b, x, y in stack]


def _sketch(words: list[str]) -> list[int]:
    """Three smallest hashes of the five-word runs: near copies mostly share each of them."""
    runs = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    return [min(xxhash.xxh3_64_intdigest(r, seed) >> 1 for r in runs) for seed in (1, 2, 3)]


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document's distinct words and stems, with its sketch."""
    held: list[tuple] = []
    for pdf in batches:
        for text, y, half in zip(pdf["text"], pdf["y"], pdf["half"]):
            words = TOKENS((text or "").lower())
            key = _sketch(words)
            own = set(words)
            own |= {w[:n] + "*" for w in own for n in STEMS if len(w) > n}
            held += [(u, y, half, *key) for u in own]
            if len(held) >= 20_000:  # a whole batch of long documents would be large
                yield pd.DataFrame(held, columns=["unit", "y", "half", "k1", "k2", "k3"])
                held = []
    if held:
        yield pd.DataFrame(held, columns=["unit", "y", "half", "k1", "k2", "k3"])


def _chain(unit: str) -> list[str]:
    """The shorter units of a unit, nearest first."""
    body = unit.rstrip("*")
    return [body[:n] + "*" for n in reversed(STEMS) if n < len(body)]


def unit_counts(sample: DataFrame) -> DataFrame:
    """unit and, for each class and half, in how many documents it occurs; a group of near copies counts about once."""
    seen = sample.select("doc_id", "text", "y", "half").repartition(24, "doc_id").mapInPandas(_units, "unit string, y int, half int, k1 long, k2 long, k3 long")
    sets = seen.groupBy("unit", "y", "half").agg(*[F.size(F.collect_set(k)).alias(k) for k in ("k1", "k2", "k3")])
    n = F.least("k1", "k2", "k3")
    return sets.groupBy("unit").agg(*[F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("half") == h), n)), F.lit(0)).alias(f"{c}{h}") for y, c in ((1, "t"), (0, "f")) for h in (0, 1)])


def collect_units(counts: DataFrame, weight: float, base: float, prior: float) -> pd.DataFrame:
    """The units that may score: those whose share stands out by the base rate's prior, all that begin with such a stem, and the stems of all these.

    weight: how many clean documents one of the sample stands for, against a toxic one.
    """
    t, f = F.expr("t0 + t1"), F.expr("f0 + f1") * F.lit(weight)
    least = 1 / (1 + (1 - base) / base / math.e)
    lead = counts.where((t >= 2) & (t + F.lit(prior * base) > F.lit(least) * (t + f + F.lit(prior)))).toPandas()
    if lead.empty:
        return lead.set_index("unit")
    spark = counts.sparkSession
    # clean words under a toxic stem count against it
    stems = [(u[:-1],) for u in lead["unit"] if u.endswith("*")]
    parts = F.explode(F.array_distinct(F.array(*[F.substring(F.regexp_replace("unit", r"\*$", ""), 1, n) for n in STEMS])))
    under = counts.select("*", parts.alias("stem")).join(F.broadcast(spark.createDataFrame(stems, "stem string")), "stem").drop("stem").distinct().toPandas() if stems else lead.head(0)
    chains = sorted({(c,) for part in (lead, under) for u in part["unit"] for c in _chain(u)})
    above = counts.join(F.broadcast(spark.createDataFrame(chains, "unit string")), "unit").toPandas() if chains else lead.head(0)
    return pd.concat([lead, under, above]).drop_duplicates("unit").set_index("unit")


def unit_scores(t: dict[str, float], f: dict[str, float], base: float, prior: float, drift: float) -> dict[str, float]:
    """Scores of the units: log-odds of the toxic share against the base rate, less the drift.

    The Dirichlet prior of a unit's share is the next shorter unit's share, that of a shortest one the base rate.
    """
    share: dict[str, float] = {}
    for u in sorted(t, key=lambda u: (len(u.rstrip("*")), not u.endswith("*"))):
        mean = next((share[c] for c in _chain(u) if c in share), base)
        share[u] = (t[u] + prior * mean) / (t[u] + f[u] + prior)
    odds = {u: math.log(p / (1 - p)) - math.log(base / (1 - base)) for u, p in share.items()}
    # a unit that scores as what it falls back to needs no entry
    return {u: s - drift for u, s in odds.items() if s > 1 or any(odds.get(c, 0) > 1 for c in _chain(u))}


def _lambda(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1; 1 if there is none."""
    if not (values > 0).any() or (values * shares).sum() >= 0:
        return 1.0
    lo, hi = 1e-6, 1.0
    f = lambda x: float((shares * np.exp(np.minimum(x * values, 600))).sum()) - 1
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression with an intercept: Newton's method on standardised features, each step halved until the loss falls."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = w / w.sum()
    penalty = np.r_[1e-9, np.full(x.shape[1], ridge)]

    def loss(b: np.ndarray) -> float:
        m = z @ b
        return float((w * (np.logaddexp(0, m) - y * m)).sum() + (penalty * b * b).sum() / 2)

    b = np.zeros(z.shape[1])
    now = loss(b)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        slope = z.T @ (w * (p - y)) + penalty * b
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), slope)
        t = 1.0
        while t > 1e-6 and loss(b - t * step) > now:
            t /= 2
        b, before = b - t * step, now
        now = loss(b)
        if before - now < 1e-10:
            break
    out = b[1:] / scale
    return np.r_[b[0] - (out * mean).sum(), out]


def fit(docs: DataFrame, labels: DataFrame, fold: int = 4, held: int = 2, rows: int = 16_384, prior: float | None = None, drift: float = 0.2) -> ToxicModel:
    """Fit on at most `rows` labelled documents outside the held-out fold.

    Each half of them is scored by counts of the other half to set lambda, K and
    the logistic curve; the model's own scores use the counts of both. The prior's
    strength is 4 for each tenfold of toxic documents, as among more documents more
    units stand out by chance.
    """
    half = F.pmod(F.xxhash64(F.lit("half"), F.coalesce("text", F.lit(""))), F.lit(2)).cast("int")
    sample = materialize(labelled_sample(docs, labels, "toxic", fold, held, rows).select("doc_id", "text", "y", half.alias("half")), "toxic-sample")
    sizes = {(r["y"], r["half"]): r["n"] for r in sample.groupBy("y", "half").agg(F.count("*").alias("n")).collect()}
    if any(not sizes.get((y, h)) for y in (0, 1) for h in (0, 1)):
        return ToxicModel({}, -drift, weights=(-3.0, 0.0, 0.0))
    n = {(y, h): sizes[y, h] for y in (0, 1) for h in (0, 1)}
    counts = materialize(unit_counts(sample), "toxic-units")
    prior = prior or 4 * math.log10(n[1, 0] + n[1, 1])
    # the classes as frequent as among the labels
    base = labels.where(F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id"), fold) != held)).agg(F.avg("toxic")).first()[0]
    weight = (1 - base) / base * (n[1, 0] + n[1, 1]) / (n[0, 0] + n[0, 1])
    table = collect_units(counts, weight, base, prior)

    def scores(halves: tuple[int, ...]) -> dict[str, float]:
        t = sum(table[f"t{h}"] for h in halves)
        f = sum(table[f"f{h}"] for h in halves) * weight
        return unit_scores(t.to_dict(), f.to_dict(), base, prior, drift) if len(table) else {}

    crossed = {h: ToxicModel(scores((1 - h,)), -drift) for h in (0, 1)}

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each document: y, tokens, largest segment; its tokens by score."""
        for pdf in batches:
            out = []
            for y, h, text in zip(pdf["y"], pdf["half"], pdf["text"]):
                own = crossed[h].scores(text)
                n, top, _ = crossed[h].features(own)
                at, times = np.unique(np.round(np.asarray(own), 2), return_counts=True)
                out.append((y, n, top, at.tolist(), times.tolist()))
            yield pd.DataFrame(out, columns=["y", "n", "top", "at", "times"])

    seen = materialize(sample.repartition(24, "doc_id").mapInPandas(profile, "y int, n long, top double, at array<double>, times array<long>"), "toxic-profile")
    plain = seen.where("y = 0").select(F.explode(F.arrays_zip("at", "times")).alias("z")).groupBy("z.at").agg(F.sum("z.times").alias("n")).toPandas()
    model = ToxicModel(scores((0, 1)), -drift)
    if len(plain):
        model.lam = _lambda(plain["at"].to_numpy(float), plain["n"].to_numpy(float) / plain["n"].sum())
    # at most `rows` short rows
    pdf = seen.select("y", "n", "top").toPandas()
    clean = pdf[(pdf["y"] == 0) & (pdf["n"] > 0)]
    if len(clean):
        # mean of the largest segment: (log(K n) + 0.5772) / lambda; wrong labels are cut off
        top = clean["top"].clip(upper=clean["top"].quantile(0.95)).mean()
        model.k = float(np.clip(np.exp(model.lam * top - 0.5772 - np.log(clean["n"]).mean()), 1e-9, 10))
    y = pdf["y"].to_numpy(float)
    w = np.where(y == 1, base / max(y.mean(), 1e-9), (1 - base) / max(1 - y.mean(), 1e-9))
    x1 = model.normal(pdf["n"].to_numpy(float), pdf["top"].to_numpy(float))
    x2 = (x1 >= -math.log(model.significance)) * math.log(2)
    b = fit_logistic(np.column_stack([x1, x2]), y, w)
    model.weights = (float(b[0]), float(max(b[1], 0)), float(max(b[2], 0)))
    return model


def apply(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score, n_passages, spans of every row: spans are the passages' first and last run and chance."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score, spans = model.judge(batch.column("text").to_pylist())
        count = [len(x) for x in spans]
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("chance", pa.float64())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(count, pa.int32()), pa.array(spans, kind)], names=["doc_id", "score", "n_passages", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, score double, n_passages int, spans array<struct<first:int,last:int,chance:double>>")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, spans of every document.

    Null and empty texts have no segment and score as such; a null doc_id is held
    out of nothing. Repeated rows score alike. Without labels of both classes every
    score is the same low one.
    """
    out = apply(docs, fit(docs, labels, fold, held))
    return out.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), fold) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages", "spans")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 4, held: int = 2) -> DataFrame:
    """The rows of docs, all columns, whose score is under the threshold. No shuffle."""
    model = fit(docs, labels, fold, held)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.judge(batch.column("text").to_pylist())[0] < threshold))

    return map_batches(docs, run, docs.schema)
