"""Exact token counts by prefix dynamic programming.

A byte-pair encoder splits a text into words that it encodes independently. In
such a word, the encoding of every prefix ends with one token, and a sequence of
tokens is the encoder's own if and only if each token encodes to itself and each
adjacent pair of tokens encodes to that pair. So one pass finds, for every prefix,
its last token and its count: try the tokens that end there, longest first, and
take the one that is compatible with the last token of the prefix it leaves.
Counts of every prefix are kept by word; a text's prefix counts are their sums, so
length, truncation and budget questions are answered without encoding again.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import map_batches

#: Bytes of Latin-1 text whose class differs between Python and the tokenizer's expressions.
_ODD = bytes([*range(0x1C, 0x20), 0x85])
#: Words kept by a worker; beyond it the memory starts anew.
CACHE_WORDS = 400_000


def byte_alphabet() -> list[str]:
    """The printable character that byte-level encoders put for each byte."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(extra))
        extra += b not in plain
    return out


class PrefixCounter:
    """Token counts of every prefix, for a byte-level BPE with word-end tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab = set(model["vocab"])
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {tuple(m): i for i, m in enumerate(pairs)}
        self.longest = max(len(t) for t in self.vocab)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        letters = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
        digits = "0-9\xb2\xb3\xb9\xbc-\xbe"
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{letters}{digits}]+").findall
        self.alphabet = byte_alphabet()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.own: dict[str, bool] = {}
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair merging of a few symbols: the definition that the table of pairs is filled from."""
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=lambda p: self.ranks.get(p, 1 << 60))
            if best not in self.ranks:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def encodes_itself(self, token: str) -> bool:
        if (known := self.own.get(token)) is None:
            known = self.own[token] = token in self.vocab and self.merged(self.symbols(token)) == [token]
        return known

    def fits(self, left: str, right: str) -> bool:
        if (known := self.pairs.get((left, right))) is None:
            known = self.pairs[left, right] = self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
        return known

    def ending(self, word: str, i: int, suffix: str, last: list[str]) -> tuple[int, str]:
        """Where the last token of word[:i] begins, and that token."""
        vocab = self.vocab
        for a in range(max(0, i - self.longest), i):
            token = word[a:i] + suffix
            if token in vocab and self.encodes_itself(token) and (a == 0 or self.fits(last[a], token)):
                return a, token
        raise ValueError(f"no token ends at {i} of {word!r}")

    def inner_counts(self, word: str) -> tuple[list[int], list[str]]:
        """Of a word in the byte alphabet: for every prefix that the word goes on from, its token count and last token."""
        last, count = [""], [0]
        vocab, own, pairs, longest = self.vocab, self.own, self.pairs, self.longest
        for i in range(1, len(word) + 1):
            for a in range(i - longest if i > longest else 0, i):
                token = word[a:i]
                if token in vocab:
                    good = own.get(token)
                    if good is None:
                        good = self.encodes_itself(token)
                    if good and a:
                        good = pairs.get((last[a], token))
                        if good is None:
                            good = self.fits(last[a], token)
                    if good:
                        break
            last.append(token)
            count.append(count[a] + 1)
        return count, last

    def word_count(self, word: str) -> int:
        """Tokens of a whole word in the byte alphabet: its stored prefix that the last, word-ending token leaves, and that token."""
        if (known := self.words.get(word)) is None:
            count, last = self.inner_counts(word[:-1])
            known = count[self.ending(word, len(word), self.end, last)[0]] + 1
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            if len(self.pairs) >= 4 * CACHE_WORDS:
                self.pairs.clear()
            if len(word) <= 64:
                self.words[word] = known
        return known

    def prefix_words(self, word: str) -> list[int]:
        """Of a word in the byte alphabet: the token count of word[:i] as a word of its own, for every i."""
        count, last = self.inner_counts(word)
        return [0, *(count[self.ending(word, i, self.end, last)[0]] + 1 for i in range(1, len(word) + 1))]

    def as_bytes(self, word: str) -> str:
        return "".join(map(self.alphabet.__getitem__, word.encode("utf-8")))

    def chunk(self, chunk: str) -> int:
        """Tokens of a run without white space, lower-cased Latin-1."""
        if (known := self.chunks.get(chunk)) is None:
            known = sum(self.word_count(self.as_bytes(w)) for w in self.split(chunk))
            if len(self.chunks) >= CACHE_WORDS:
                self.chunks.clear()
            if len(chunk) <= 64:
                self.chunks[chunk] = known
        return known

    def steps(self, text: str) -> list[int]:
        """Token counts of the text's consecutive parts: special strings, and runs without white space.

        Text beyond Latin-1 is normalised and split by the library itself, whose
        words are then counted in the same way.
        """
        if "<|" in text and self.at_special and (cuts := list(self.at_special.finditer(text))):
            out, at = [], 0
            for m in cuts:
                out += [*self.steps(text[at : m.start()]), 1]
                at = m.end()
            return out + self.steps(text[at:])
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            raw = None
        if raw is not None and len(raw) == len(raw.translate(None, _ODD)):
            # lower() of Latin-1 stays Latin-1 and is what the tokenizer does char by char
            chunks, get = text.lower().split(), self.chunks.get
            return [n if (n := get(c)) is not None else self.chunk(c) for c in chunks]
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [self.word_count(w) for w, _ in words]

    def count(self, text: str | None) -> int:
        return sum(self.steps(text)) if text else 0

    def fitting(self, text: str | None, budget: int) -> int:
        """How many of the text's consecutive parts fit into the budget."""
        return bisect_right(list(accumulate(self.steps(text or ""))), budget)

    def prefix_counts(self, word: str) -> tuple[int, ...]:
        """Token counts of word[:i] for every i, for a lower-case word that the tokenizer doesn't split."""
        counts = self.prefix_words(self.as_bytes(word))
        at = [0, *accumulate(len(c.encode("utf-8")) for c in word)]
        return tuple(counts[i] for i in at)


_counters: dict[str, PrefixCounter] = {}


def counter(path: str | None = None) -> PrefixCounter:
    """The counter for a tokenizer file, one for each worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_parts of every row.

    Null and empty texts have 0 bytes and 0 tokens. fit_parts: how many of the
    text's consecutive white-space-free parts the limit holds. Repeated rows are
    counted each; a very long text is one pass over its parts. No shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path)
        n_tokens, fit = [], []
        for text in batch.column("text").to_pylist():
            steps = own.steps(text) if text else []
            n = sum(steps)
            n_tokens.append(n)
            fit.append(len(steps) if n <= limit else bisect_right(list(accumulate(steps)), limit))
        cols = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(fit, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_parts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_parts long")
