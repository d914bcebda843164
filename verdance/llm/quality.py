"""Document quality by votes of the nearest labelled documents in latent-semantic space.

The terms of a document are its words and their runs of four letters, hashed, and pairs
of adjacent character classes (letters by case, digits, spaces, line ends, each mark), so
that symbol salad, shouting, link lists and the like have terms of their own in every
language, and counts of words that repeat the one before and of words that aren't new.
Term counts, damped and weighted by rarity, each kind at length 1, are projected on the
leading singular vectors of a bounded sample of labelled documents. Those sample vectors
go to every task; each document's cosine with all of them is computed exactly, in blocks,
and its nearest vote by similarity.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import fold_of, labelled_sample, map_batches, materialize, text_bytes

MARKS = b".,;:!?'\"-_/\\|%*#$&@+=()[]{}<>~^`"
#: Class of every byte: 0 white space, 1 line end, 2 small letter (all of UTF-8's bytes beyond ASCII too), 3 capital, 4 digit, 5 control, then each mark.
CLASSES = np.full(256, 5, np.int64)
CLASSES[[9, 11, 12, 32]] = 0
CLASSES[[10, 13]] = 1
CLASSES[97:123] = CLASSES[128:] = 2
CLASSES[65:91] = 3
CLASSES[48:58] = 4
CLASSES[list(MARKS)] = np.arange(6, 6 + len(MARKS))
N = 6 + len(MARKS)
#: The pairs; then words that repeat their predecessor, words seen before in the text, words, and the empty text.
SHAPES = N * N + 4
#: Buckets of words and of their runs of letters.
WORDS, RUNS = 4096, 2048
TERMS = SHAPES + WORDS + RUNS
BLOCK = 256
#: Length of the words' part of a vector, and of the runs', against 1 of the shapes'.
LEXICAL = 0.6
CACHE = 200_000
_hashed: dict[bytes, bytes] = {}


def hashed(word: bytes) -> bytes:
    """Buckets of a word and of its runs of four letters, as 16-bit numbers."""
    edged = b"^" + word + b"$"
    runs = {WORDS + crc32(edged[i : i + 4]) % RUNS for i in range(len(edged) - 3)} if len(word) <= 32 else ()
    known = array("H", (crc32(word) % WORDS, *sorted(runs))).tobytes()
    if len(_hashed) >= CACHE:
        _hashed.clear()
    if len(word) <= 64:
        _hashed[word] = known
    return known


def term_counts(raw: bytes) -> np.ndarray:
    """Counts of the whole text's terms; of words and runs, in how many distinct words they occur."""
    out = np.zeros(TERMS, np.float32)
    codes = np.frombuffer(raw, np.uint8)
    for a in range(0, len(raw) - 1, 1 << 20):
        c = CLASSES[codes[a : a + (1 << 20) + 1]]
        out[: N * N] += np.bincount(c[:-1] * N + c[1:], minlength=N * N)
    words = raw.split()
    if words:
        get, distinct = _hashed.get, set(raw.lower().split())
        out[N * N : SHAPES] = sum(map(eq, words, words[1:])), len(words) - len(set(words)), len(words), 0
        at = np.frombuffer(b"".join([get(w) or hashed(w) for w in distinct]), np.uint16)
        out[SHAPES:] = np.bincount(at, minlength=WORDS + RUNS)
    else:
        out[SHAPES - 1] = 1
    return out


@dataclass
class QualityModel:
    rarity: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    #: Weight of a vote for each class: documents that a sampled one stands for.
    votes: tuple[float, float]
    neighbours: int = 25
    sharpness: float = 12.0

    def project(self, counts: np.ndarray) -> np.ndarray:
        y = _weighed(counts, self.rarity) @ self.basis
        return (y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of the similarity-weighted votes for label 1 among the nearest labelled vectors."""
        out = np.empty(len(counts))
        k = min(self.neighbours, len(self.labels))
        weight = np.where(self.labels == 1, self.votes[1], self.votes[0])
        for a in range(0, len(counts), BLOCK):
            cos = self.project(counts[a : a + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            own = np.take_along_axis(cos, near, axis=1)
            w = np.exp(self.sharpness * (own - own.max(axis=1, keepdims=True)).astype(float)) * weight[near]
            out[a : a + BLOCK] = (w * (self.labels[near] == 1)).sum(axis=1) / w.sum(axis=1)
        return out


def _damp(counts: np.ndarray) -> np.ndarray:
    """Counts of shapes as shares of the document's pairs, square-rooted: long and short texts alike; words and runs by logarithm."""
    x = np.log1p(counts)
    own = counts[:, :SHAPES]
    total = np.maximum(own[:, : N * N].sum(axis=1, keepdims=True), 1)
    x[:, :SHAPES] = np.sqrt(own / total)
    x[:, N * N : N * N + 2] *= 2
    x[:, SHAPES - 1] = own[:, -1]
    return x


def _weighed(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Damped counts by rarity, each kind of terms at its length: shapes 1, words and runs `LEXICAL`."""
    x = _damp(counts) * rarity
    for a, b, share in ((0, SHAPES, 1.0), (SHAPES, SHAPES + WORDS, LEXICAL), (SHAPES + WORDS, TERMS, LEXICAL)):
        x[:, a:b] *= share / np.maximum(np.linalg.norm(x[:, a:b], axis=1, keepdims=True), 1e-12)
    return x


def leading(blocks: Callable[[], Iterator[np.ndarray]], terms: int, rows: int, dims: int, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors, as columns, by power steps on a random subspace; blocks gives the rows again and again."""
    k = min(dims + 16, rows, terms)
    q = np.random.default_rng(seed).standard_normal((terms, k)).astype(np.float32)
    for _ in range(4):
        q = np.linalg.qr(sum(d.T @ (d @ q) for d in blocks()))[0]
    _, _, v = np.linalg.svd(np.concatenate([d @ q for d in blocks()]), full_matrices=False)
    return (q @ v.T)[:, : min(dims, k)].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, fold: int = 5, held: int = 0, rows: int = 4096, dims: int = 64) -> QualityModel | None:
    """Fit on at most `rows` labelled documents outside the held-out fold, half of each class; None if there are none."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts = [term_counts(t) for t in pdf["raw"]]
            at = [np.flatnonzero(c).astype("<u2") for c in counts]
            yield pd.DataFrame({"y": pdf["y"], "at": [a.tobytes() for a in at], "n": [c[a].tobytes() for c, a in zip(counts, at)]})

    sample = materialize(labelled_sample(docs, labels, "quality", fold, held, rows).select("doc_id", text_bytes().alias("raw"), "y"), "quality-sample")
    # at most `rows` rows of at most TERMS numbers
    got = sample.repartition(24, "doc_id").mapInPandas(count, "y int, at binary, n binary").toPandas()
    if got.empty:
        return None
    got = got.sort_values(["y", "at", "n"], ignore_index=True)
    y, rows = got["y"].to_numpy(), list(zip(got["at"], got["n"]))
    del got

    def counts() -> Iterator[np.ndarray]:
        """The sample's counts, a block of documents at a time."""
        for a in range(0, len(rows), BLOCK):
            x = np.zeros((len(rows[a : a + BLOCK]), TERMS), np.float32)
            for row, (at, n) in zip(x, rows[a : a + BLOCK]):
                row[np.frombuffer(at, "<u2")] = np.frombuffer(n, np.float32)
            yield x

    share = labels.where(F.col("quality").isin(0, 1) & (fold_of(F.col("doc_id"), fold) != held)).agg(F.avg("quality")).first()[0]
    seen = max(float(y.mean()), 1e-9), max(1 - float(y.mean()), 1e-9)
    rarity = (1 + np.log(len(rows) / (1 + sum((x > 0).sum(axis=0) for x in counts())))).clip(min=0.5).astype(np.float32)
    basis = leading(lambda: (_weighed(x, rarity) for x in counts()), TERMS, len(rows), dims)
    model = QualityModel(rarity, basis, np.empty((0, 0)), y.astype(np.int8), ((1 - share) / seen[1], share / seen[0]))
    model.vectors = np.concatenate([model.project(x) for x in counts()])
    return model


def scorer(docs: DataFrame, labels: DataFrame, fold: int, held: int) -> Callable[[list[bytes]], np.ndarray]:
    """Scores of texts as UTF-8, by the model that every task gets: at most `rows` vectors of `dims` floats."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, fold, held))

    def judge(raw: list[bytes]) -> np.ndarray:
        own, scores = shared.value, []
        for a in range(0, len(raw), BLOCK):
            part = raw[a : a + BLOCK]
            scores.append(own.score(np.stack([term_counts(t) for t in part])) if own else np.full(len(part), 0.5))
        return np.concatenate(scores) if scores else np.empty(0)

    return judge


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null and empty texts count as one and the same text without words. A null doc_id
    is held out of nothing; repeated rows score alike; without labels every score is 0.5.
    """
    judge = scorer(docs, labels, fold, held)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(judge(batch.column("raw").to_pylist()))], names=["doc_id", "score"])

    out = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("raw")), run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), fold) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 5, held: int = 0) -> DataFrame:
    """The rows of docs, all columns, whose score reaches the threshold. No shuffle."""
    judge = scorer(docs, labels, fold, held)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [(t or "").encode("utf-8") for t in batch.column("text").to_pylist()]
        return batch.filter(pa.array(judge(raw) >= threshold))

    return map_batches(docs, run, docs.schema)
