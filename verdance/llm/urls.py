"""URL filtering by rules, then by naive Bayes over segmented words.

Host and path are cut at everything but letters, and each name is split into words
by Viterbi over a unigram model. Its lexicon is the words of a public vocabulary file,
whose order is that of frequency, and the words of the examples. Half of a word's
probability is by its rank there, half is its share among the words of all urls of the
table: these are split once by rank alone, and counted. Stretches that no word covers
cost by letter.

A multinomial naive Bayes scores the words of host and path. Each class is half its
example words, half the language; words that no example holds are scored by their runs
of four letters, in the same way, so that unseen names and forms are judged as well.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import map_batches

#: Example words that the classifier is fitted on: what names of unwanted sites and of others are made of.
BLOCK_EXAMPLES = """
casino casinos poker roulette blackjack slots bingo baccarat jackpot jackpots gambling gamble betting bets bet bettor wager wagering bookmaker sportsbook lottery lotto sweepstakes
porn porno pornstar sex sexy sexcam xxx adult adults nude nudes naked erotic erotica escort escorts hentai fetish webcam camgirls strippers hookup milf
viagra cialis levitra tramadol xanax pharma pills pill meds steroids slimming testosterone painkillers
payday loans loan forex binary bitcoin crypto profits millionaire ponzi scam scams scammer moneymaking getrich
spam spammer spamming backlinks linkfarm clickbait popunder popup popups adserver adclick adtrack ads advert tracker pixel affiliate
malware spyware trojan phishing keygen cracked crack warez torrent torrents pirated nulled botnet rootkit keylogger
cheap cheapest replica counterfeit free win winner winners prize prizes instant unlimited guaranteed miracle
""".split()
ALLOW_EXAMPLES = """
news daily weekly press journal magazine article report reporter editor world local politics government parliament council city town county state court law justice police
school schools college university education teacher student students course courses lecture class library libraries book books reader author archive archives research science paper history museum art gallery exhibition theatre
health hospital doctor patient care clinic nurse medicine research family children community church charity volunteer event events
music concert album film movie cinema review video photo photos gallery sport sports football tennis team league club match player players
food recipe recipes kitchen cooking garden gardens home house plant plants nature park wildlife animal animals river mountain lake weather climate forecast travel hotel hotels flight flights guide map maps
software code open source project projects docs documentation download downloads manual support help forum wiki blog blogs post posts page pages about contact service services account login index search category product products shop store item items order cart price job jobs career office company business market finance bank economy tax insurance
language dictionary word words grammar translation culture tradition
""".split()
#: Cost of beginning a stretch that no word covers, of each of its letters, and what words of two letters cost more.
GAP, LETTER, SHORT = 6.0, 3.0, 4.0
#: Share of the language in each class, and weight of runs of letters against a whole word.
LANGUAGE, RUNS = 0.5, 0.7
PRIOR = 0.1
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
NAMES = re.compile(r"[a-z]+").findall
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: then up to ?, # or the end. Null or no ://: empty."""
    pattern = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(part(1), UPPER, UPPER.lower()), part(2)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none. Of equally long ones the smaller string wins."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


@lru_cache(2)
def lexicon(path: str | None = None) -> dict[str, float]:
    """Words of a vocabulary file with word ends, and their probabilities by rank."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    end = model.get("end_of_word_suffix") or ""
    found = sorted((i, t[: len(t) - len(end)]) for t, i in model["vocab"].items() if t.endswith(end))
    words = list(dict.fromkeys(w for _, w in found if re.fullmatch("[a-z]{2,}", w)))
    total = sum(1 / (r + 3) for r in range(len(words)))
    return {w: 1 / (r + 3) / total for r, w in enumerate(words)}


@dataclass
class UrlModel:
    #: Cost of each word: its negative log probability.
    words: dict[str, float]
    #: Log-odds for block of the examples' words, and of runs of four letters.
    odds: dict[str, float]
    runs: dict[str, float] = field(default_factory=dict)
    prior: float = math.log(PRIOR / (1 - PRIOR))
    names: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.words), default=1)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"names": {}}

    def segment(self, name: str) -> tuple[str, ...]:
        """The cheapest split into words and uncovered stretches, in one pass."""
        if (known := self.names.get(name)) is not None:
            return known
        n = len(name)
        done, gap = [0.0] + [math.inf] * n, [math.inf] * (n + 1)  # best cost up to i after a word, and within a stretch
        came: list[str] = [""] * (n + 1)
        begun = [0] * (n + 1)
        for i in range(1, n + 1):
            if done[i - 1] + GAP <= gap[i - 1]:
                gap[i], begun[i] = done[i - 1] + GAP + LETTER, i - 1
            else:
                gap[i], begun[i] = gap[i - 1] + LETTER, begun[i - 1]
            done[i], at = gap[i], begun[i]
            for a in range(max(0, i - self.longest), i):
                cost = self.words.get(name[a:i])
                if cost is not None and done[a] + cost < done[i]:
                    done[i], at = done[a] + cost, a
            came[i] = at
        out, i = [], n
        while i:
            out.append(name[came[i] : i])
            i = came[i]
        split = tuple(reversed(out))
        if len(self.names) >= 100_000:
            self.names.clear()
        if n <= 64:
            self.names[name] = split
        return split

    def tokens(self, host: str, path: str) -> list[str]:
        return [w for name in NAMES(f"{host} {path}".lower()) for w in self.segment(name)]

    def word(self, w: str) -> float:
        """Log-odds for block of one word."""
        if (known := self.odds.get(w)) is not None:
            return known
        own = [self.runs.get(r, 0.0) for r in runs_of(w)]
        return RUNS * sum(own) / len(own) if own else 0.0

    def score(self, tokens: list[str]) -> float:
        """Log-odds for block."""
        return self.prior + sum(map(self.word, tokens))


def runs_of(word: str) -> list[str]:
    """Runs of four letters of a word and its edges; shorter words have none."""
    edged = f"^{word}$"
    return [edged[i : i + 4] for i in range(len(edged) - 3)] if len(word) > 3 else []


def naive_bayes(block: Iterable[str], allow: Iterable[str], language: dict[str, float]) -> tuple[dict[str, float], dict[str, float]]:
    """Log-odds for block of the examples' words, and of the runs of letters in them."""
    counts = [Counter(w for x in own for w in NAMES(x)) for own in (block, allow)]
    runs = [Counter(r for w, n in c.items() for r in runs_of(w) for _ in range(n)) for c in counts]
    rest = min(language.values(), default=1e-6)
    of_runs: Counter = Counter()
    for w, p in language.items():
        for r in runs_of(w):
            of_runs[r] += math.sqrt(p)  # rare words shape a language's names as well
    total = sum(of_runs.values()) or 1.0

    def odds(x: str, c: list[Counter], base: float) -> float:
        share = [(1 - LANGUAGE) * own[x] / max(1, own.total()) + LANGUAGE * base for own in c]
        return math.log(share[0] / share[1])

    words = {w: odds(w, counts, language.get(w, rest)) for w in counts[0].keys() | counts[1].keys()}
    return words, {r: odds(r, runs, max(of_runs[r], 0.1 * math.sqrt(rest)) / total) for r in runs[0].keys() | runs[1].keys()}


def fit(urls: DataFrame, block: list[str] | None = None, allow: list[str] | None = None, vocabulary: str | None = None) -> UrlModel:
    """The model; shares of the lexicon's words are counted over the split names of all urls (host, path)."""
    language = dict(lexicon(vocabulary))
    odds, runs = naive_bayes(BLOCK_EXAMPLES if block is None else block, ALLOW_EXAMPLES if allow is None else allow, language)
    least = min(language.values(), default=1e-6)
    for w in odds:
        language.setdefault(w, least)
    more = {w: SHORT if len(w) < 3 and w not in odds else 0.0 for w in language}
    first = UrlModel({w: more[w] - math.log(p) for w, p in language.items()}, odds, runs)

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([[w for w in first.segment(x) if w in first.words] for x in batch.column("name").to_pylist()], pa.list_(pa.string())), batch.column("n")], names=["words", "n"])

    names = urls.select(F.explode(F.split(F.lower(F.concat_ws(" ", "host", "path")), "[^a-z]+")).alias("name")).where("name <> ''").groupBy("name").agg(F.count("*").alias("n"))
    # a row at most for each word of the lexicon
    seen = map_batches(names, split, "words array<string>, n long").select(F.explode("words").alias("w"), "n").groupBy("w").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in seen) or 1
    share = {r["w"]: r["n"] / total for r in seen}
    return UrlModel({w: more[w] - math.log(0.5 * p + 0.5 * share.get(w, 0.0)) for w, p in language.items()}, odds, runs)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] | None = None, block: list[str] | None = None, allow: list[str] | None = None, vocabulary: str | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score, words of every row.

    A null url, or one without ://, has empty host and path; no rule fits it, and
    having no words it is allowed. Repeated rows are judged alike; letters beyond a to z
    part names. One pass counts names, one judges; only distinct names are shuffled.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), RULES if rules is None else rules)
    model = fit(urls, block, allow, vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [model.tokens(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
        score = [model.score(w) for w in words]
        verdict = [v or ("block" if s > 0 else "allow") for v, s in zip(batch.column("verdict").to_pylist(), score)]
        cols = [*(batch.column(c) for c in ("page_id", "host", "path", "rule")), pa.array(verdict, pa.string()), pa.array(score, pa.float64()), pa.array(words, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(cols, names=["page_id", "host", "path", "rule", "verdict", "score", "words"])

    ruled = urls.withColumns({"rule": rule, "verdict": verdict}).select("page_id", "host", "path", "rule", "verdict")
    return map_batches(ruled, run, "page_id long, host string, path string, rule string, verdict string, score double, words array<string>")
