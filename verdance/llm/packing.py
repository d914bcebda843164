"""Bound-certified best-fit packing of token sequences.

Documents are encoded, ended with a separator id and cut into pieces. Pieces are
dealt into partitions of bounded size; each is packed best-fit decreasing, and
dual-feasible functions give a lower bound of its bins. A partition whose bins
equal its bound is certified. The others, and the emptiest bin of every partition
(rounding up by partition may cost one), hand over the pieces of their unfilled
bins; these are dealt anew and packed again, until the bins reach the bound of all
pieces together or a round gains nothing.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import map_batches, materialize
from verdance.llm.tokens import byte_alphabet

_ODD = bytes([*range(0x1C, 0x20), 0x85])
#: A run that the rank encoder, whose time grows with the square of a run's length, isn't given.
_LONG = re.compile(rb"\S{4000}|\s{4000}").search
#: Pieces that one partition packs, about.
PARTITION = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Rounds of exchange between partitions, at most; each ends sooner if it gains nothing or the bound is reached.
ROUNDS = 4


class Encoder:
    """Token ids of the tokenizer file as little-endian 32-bit bytes.

    The file's merges are in the order of their ids, so its vocabulary read as ranks
    gives the same ids; that is checked when it is read. The rank encoder is quicker.
    Texts beyond Latin-1, with odd control characters or special strings go to the
    library that the file is written for, as does every text if the check fails.
    """

    #: The pattern of byte-level pre-tokenizers.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str | None = None):
        import tiktoken
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        plain &= not model.get("end_of_word_suffix") and not model.get("ignore_merges") and merged == sorted(merged)
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if set(t) <= byte.keys()}
        self.ranked = tiktoken.Encoding("file", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}) if plain else None

    def exact(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return self.exact(text)
        if self.ranked is None or "<|" in text or len(raw) != len(raw.translate(None, _ODD)) or _LONG(raw):
            return self.exact(text)
        return self.ranked.encode_to_numpy(text).astype("<u4").tobytes()


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, size: int = 1024, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Every document's pieces: its ids and end_id, cut if longer than size; only the first piece may be shorter.

    A null or empty text is the end id alone. Repeated rows give repeated pieces.
    """
    mark = np.asarray([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path)
        cols: list[list] = [[], [], [], [], []]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = own(text) + mark
            n = len(ids) // 4
            at, k = 0, 0
            step = n - (n - 1) // size * size
            while at < n:
                for c, x in zip(cols, (doc_id, k, at, step, zlib.crc32(ids[4 * at : 4 * (at + step)]))):
                    c.append(x)
                at, k, step = at + step, k + 1, size
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, PIECES)


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Least bins for counts[x] items of length x, 0 < x <= size, by two families of dual-feasible functions."""
    x = np.arange(size + 1)
    total = int((counts * x).sum())
    best = -(-total // size)
    n, s = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * x)])
    # u_a: items over size - a count a whole bin, those under a nothing
    a = np.arange(1, size // 2 + 1)
    big = n[-1] - n[size - a + 1]
    mid = s[size - a + 1] - s[a]
    best = max(best, int((big + -(-mid // size)).max(initial=0)))
    # f_k: lengths rounded to multiples of size / k, down unless (k + 1) x / size is whole
    for k in range(1, 65):
        whole = (k + 1) * x % size == 0
        scaled = np.where(whole, x * k, (k + 1) * x // size * size)
        best = max(best, int(-(-int((counts * scaled).sum()) // (k * size))))
    return best


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every length, and the fill of every bin. One step for each item: bins lie in stacks by free room, a bit for each stack."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0
    for i, x in zip(order.tolist(), lengths[order].tolist()):
        above = rooms >> x
        if above:
            room = x + (above & -above).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms &= ~(1 << room)
        else:
            room, b = size, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += x
        if left := room - x:
            stacks[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.asarray(fill, np.int64)


def _deal(df: DataFrame, n: int, salt: int, partition: int) -> DataFrame:
    """The pieces with their partition, by a hash of all that a piece is.

    Equal pieces share a hash: where one of 65,536 ranges of it holds more than half a
    partition, its pieces are dealt by their place in the written table as well.
    """
    key = F.xxhash64(F.lit(salt), "doc_id", "piece", "start", "length", "ids_crc32")
    part = lambda k: F.pmod(k, F.lit(n)).cast("int")
    rows = df.select("doc_id", "piece", "start", "length", "ids_crc32", key.alias("key"), F.monotonically_increasing_id().alias("place"))
    coarse = F.shiftrightunsigned("key", 48)
    # at most 65,536 rows
    hot = rows.groupBy(coarse.alias("c")).count().where(F.col("count") > partition // 2).select("c")
    if n > 1 and not hot.isEmpty():
        rows = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), coarse == F.col("c"), "left").drop("c")
        return rows.withColumn("part", part(F.when(F.col("hot"), F.xxhash64("key", "place")).otherwise(F.col("key")))).drop("key", "place", "hot")
    return rows.withColumn("part", part(F.col("key"))).drop("key", "place")


def _pack(df: DataFrame, n: int, salt: int, size: int, partition: int = PARTITION) -> DataFrame:
    """One round: deal the pieces into partitions and pack each. loose: the bin may be handed over; gap: bins of its partition over the bound."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # an order that the dealing does not decide
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, size)
        gap = len(fill) - lower_bound(np.bincount(lengths, minlength=size + 1), size)
        loose = (fill < size) if gap else np.arange(len(fill)) == fill.argmin()
        loose &= fill < size
        base = (np.int64(salt) << 56) + (np.int64(key[0]) << 24)
        return pdf.drop(columns="part").assign(sequence_id=base + bins, offset=offsets, loose=loose[bins], gap=gap)

    return _deal(df, n, salt, partition).groupBy("part").applyInPandas(run, f"{PIECES}, sequence_id long, offset long, loose boolean, gap long")


def pack(rows: DataFrame, size: int = 1024, partition: int = PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """The pieces with sequence_id, offset and gap. Sequence ids are any distinct numbers; offsets are gapless from 0.

    gap: by how many bins the partition that packed the piece is over its certified
    bound; 0 is proven best. An empty table gives an empty one. Which pieces meet depends
    on what they are, so reruns agree, but for pieces of which there are very many equal
    ones. Bins that a round improves replace those they came from; there are at most
    `rounds` rounds.
    """
    rows = materialize(rows, "pieces")
    # at most `size` rows, one for each length
    counts = np.zeros(size + 1, np.int64)
    for length, n in rows.groupBy("length").count().collect():
        counts[length] = n
    total, bound = int(counts.sum()), lower_bound(counts, size)
    out = materialize(_pack(rows, max(1, -(-total // partition)), 1, size, partition), "packed")
    used = out.where("offset = 0").count()
    for k in range(2, rounds + 2):
        if used <= bound or total <= partition:
            break
        pool = out.where("loose")
        n, before = pool.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        again = materialize(_pack(pool, max(1, -(-n // partition)), k, size, partition), "packed")
        after = again.where("offset = 0").count()
        if after >= before:
            break
        used += after - before
        out = out.where("not loose").unionByName(again)
    return out.drop("loose")


def packed_sequences(docs: DataFrame, size: int = 1024, end_id: int = 2, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, gap of every piece of every document."""
    return pack(pieces(docs, size, end_id, path), size)
