"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding look-alikes."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from obslake.llm.columns import unused
from obslake.llm.hashing import U64, mix, packs
from obslake.llm.ngram_join import shingle_sets
from obslake.session import cut_lineage

# At most this many labelled rows are fitted, half of each label, taken by a hash of the id.
TRAIN_ROWS = 20_000
# A term occurs in so many toxic texts, and so many times as often as in others.
MIN_SUPPORT, MIN_ODDS = 4, 8.0
# The terms expected to pass by chance, among all that are tested.
BY_CHANCE = 1.0
COUNTED_AT_ONCE = 1 << 18
SCORED_AT_ONCE = 1024
STEMS = range(4, 9)
# Copies agree in so many of so many least hashes of their shingles of three words: a similarity of about 0.8.
AGREE, MINIMA = 26, 32

# Letters of other scripts and signs that look like Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "ɑ": "a", "ɡ": "g",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"
BREAKS = "\t\n\r\x0b\x0c!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~ «»“”„‘’–—…¡¿·•"

# Phrases in which a term is no insult.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "trash bag", "trash collection", "pond scum", "sore loser rule")


def _folding() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(c): " " for c in BREAKS}
    for letter, latin in LOOKALIKES.items():
        table[ord(letter)] = latin
        table[ord(letter.upper()[0])] = latin
    table |= {ord(d): latin for d, latin in DIGITS.items()}
    table |= {0xFF41 + k: chr(0x61 + k) for k in range(26)} | {0xFF21 + k: chr(0x61 + k) for k in range(26)}
    return table | dict.fromkeys(map(ord, INVISIBLE))


_FOLD = _folding()


def folded(text: str | None) -> str:
    """Lower case, look-alikes and digits as the letters they stand for, signs as spaces, one space in front."""
    return " " + (text or "").lower().translate(_FOLD)


@dataclass
class Lexicon:
    """Terms that begin a word, their weights, and a logistic scale from the two measures of a text to its score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    scale: tuple[float, ...] = (-4.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(" " + term, (len(term) + 1, weight))
        for phrase in map(folded, self.exceptions):
            # A phrase that is a term as well clears it.
            found.add_word(phrase, (len(phrase), 0.0))
        found.make_automaton()
        return found

    def score(self, measures: np.ndarray) -> np.ndarray:
        z = self.scale[0] + measures @ np.array(self.scale[1:])
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def measured(text: str, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """The weight of all terms in a folded text, and that weight by its length: both logarithmic."""
    total, free, held = 0.0, -1, []
    if len(automaton):
        for end, (length, weight) in automaton.iter(text):
            if weight == 0.0:
                free = max(free, end)
                held = [(s, w) for s, w in held if s < end - length + 1]
            else:
                held.append((end - length + 1, weight))
        total = sum(w for _, w in held)
    return float(np.log1p(total)), float(np.log1p(100 * total / (text.count(" ") + 1)))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text is divisible by 5.  False without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _prepare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Folded texts with the least hashes of their shingles, each under another order."""
    seeds = mix(np.arange(1, MINIMA + 1, dtype=U64))
    for frame in frames:
        texts, minima = [folded(t) for t in frame["text"]], []
        for _, pack in packs(t.encode() for t in texts):
            for own in shingle_sets(pack, 3):
                least = [mix(own ^ seed).min() for seed in seeds] if len(own) else [U64(0)] * MINIMA
                minima.append((np.array(least, dtype=U64) >> U64(32)).astype("<u4").tobytes())
        yield frame[["toxic"]].assign(minima=minima, text=texts)


def _first_copies(rows: list) -> list[tuple[int, int]]:
    """Label and key of the texts that are no near copies of one with a smaller key and the same label."""
    kept = []
    for label in (0, 1):
        own = sorted((r.key, bytes(r.minima)) for r in rows if r.toxic == label)
        held, n, seen = np.zeros((len(own), MINIMA), dtype="<u4"), 0, set()
        for key, minima in own:
            if minima in seen:
                continue
            seen.add(minima)
            mine = np.frombuffer(minima, dtype="<u4")
            if n and np.count_nonzero(held[:n] == mine, axis=1).max() >= AGREE:
                continue
            held[n] = mine
            n += 1
            kept.append((label, key))
    return kept


def _stems(text: str) -> set[str]:
    whole = {w for w in text.split() if len(w) >= 3}
    return whole | {w[:n] for w in whole for n in STEMS if len(w) > n}


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many texts of each label a term occurs; a term can come several times."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def counted() -> pd.DataFrame:
        terms = list(seen[0].keys() | seen[1].keys())
        other, toxic = (np.array([c[t] for t in terms], dtype=np.int64) for c in seen)
        return pd.DataFrame({"term": terms, "toxic": toxic, "other": other})

    for frame in frames:
        for label, text in zip(frame["toxic"], frame["text"]):
            seen[label].update(_stems(text))
            if len(seen[0]) + len(seen[1]) > COUNTED_AT_ONCE:
                yield counted()
                seen = (Counter(), Counter())
    if seen[0] or seen[1]:
        yield counted()


def _odds(toxic, other, n_toxic: int, n_other: int):
    return ((toxic + 0.5) / (n_toxic + 1)) / ((other + 1.0) / (n_other + 1))


def _log_chance(toxic: np.ndarray, other: np.ndarray, share: float) -> np.ndarray:
    """Logarithm of the chance that of ``toxic`` + ``other`` texts as many or more are toxic, if ``share`` of all texts is.

    The first term of the binomial tail and a geometric series for the rest, which is no less.
    """
    log_factorial = np.frompyfunc(lambda x: math.lgamma(x + 1), 1, 1)
    first = (log_factorial(toxic + other) - log_factorial(toxic) - log_factorial(other)).astype(float)
    first += toxic * math.log(share) + other * math.log1p(-share)
    ratio = other / (toxic + 1) * share / (1 - share)
    return np.where(ratio < 1, np.minimum(first - np.log1p(-np.minimum(ratio, 1 - 1e-9)), 0.0), 0.0)


def _telling(n_toxic: int, n_other: int, tested: int):
    """Terms that are no chance find, however many are tested."""

    def telling(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            toxic, other = frame["toxic"].to_numpy(), frame["other"].to_numpy()
            chance = _log_chance(toxic, other, n_toxic / (n_toxic + n_other))
            yield frame[(_odds(toxic, other, n_toxic, n_other) >= MIN_ODDS) & (chance <= math.log(BY_CHANCE / tested))]

    return telling


def _chosen(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int) -> dict[str, float]:
    """The weights of all terms; of a term and a stem of it that is about as telling, the stem."""
    weights = {t: math.log(_odds(n, other.get(t, 0), n_toxic, n_other)) for t, n in toxic.items()}
    for term in sorted(weights, key=len):
        stems = [term[:n] for n in range(3, len(term)) if term[:n] in weights]
        if any(weights[s] >= weights[term] - 0.7 for s in stems):
            del weights[term]
        else:
            for s in stems:
                del weights[s]
    return dict(sorted(weights.items()))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack((np.ones(len(x)), x))
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-3] * (x.shape[1] - 1)) * len(x)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, beta))


def _measure(lexicon: Lexicon):
    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for frame in frames:
            found = [measured(t, automaton) for t in frame["text"]]
            yield pd.DataFrame({"toxic": frame["toxic"], "weight": [f[0] for f in found], "density": [f[1] for f in found]})

    return measure


def fit_lexicon(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Lexicon:
    """The lexicon and scale that tell toxic texts, learned from labelled rows that are not held out.

    ``train_rows`` bounds the labelled rows that are used, half of them of each label; they are
    taken by a hash of the id and joined by broadcast.  Near copies count once: of the texts of
    one label whose shingles of three words agree by about 0.8 or more one is used.  Terms are words and their first
    letters; their counts come from all texts used.  A term is taken if it is ``MIN_ODDS`` times as
    frequent in toxic texts as in others, and if ``BY_CHANCE`` terms at most would stand out like
    that by chance among all that are tested; no share of the toxic texts is asked for, and every
    such term is taken.  A few phrases in which a term is no insult (``EXCEPTIONS``) do not count.  Labels other than 0 and 1, or without id or
    text, are not used.  Without a toxic or another text the lexicon is empty and no text is toxic.
    """
    rows = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    shares = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    by_hash = rows.orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = by_hash.where("toxic = 1").limit(train_rows // 2).union(by_hash.where("toxic = 0").limit(train_rows // 2))
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(rows), "doc_id")
    texts = texts.select("toxic", "text").mapInPandas(_prepare, "toxic int, minima binary, text string")
    texts = cut_lineage(texts.withColumn("key", F.xxhash64("text")).dropDuplicates(["toxic", "key"]))
    once = _first_copies(texts.select("toxic", "key", "minima").collect())
    once = docs.sparkSession.createDataFrame(once, "toxic int, key long")
    texts = cut_lineage(texts.join(F.broadcast(once), ["toxic", "key"]).select("toxic", "text"))
    numbers = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(numbers) < 2:
        return Lexicon()

    counts = texts.mapInPandas(_count, "term string, toxic long, other long").groupBy("term")
    counts = cut_lineage(counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(F.col("toxic") >= MIN_SUPPORT))
    telling = counts.mapInPandas(_telling(numbers[1], numbers[0], max(1, counts.count())), counts.schema)
    # Each is in MIN_SUPPORT or more of a bounded number of texts.
    found = telling.collect()
    toxic, other = {r.term: r.toxic for r in found}, {r.term: r.other for r in found}
    lexicon = Lexicon(_chosen(toxic, other, numbers[1], numbers[0]))
    rows = texts.mapInPandas(_measure(lexicon), "toxic int, weight double, density double").collect()
    y = np.array([r.toxic for r in rows], dtype=float)
    # Each label weighs what it does among all labelled rows.
    share = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    x = np.array([(r.weight, r.density) for r in rows])
    lexicon.scale = _logistic(x, y, share * len(y) / share.sum())
    return lexicon


def _score(lexicon: Lexicon, column: str):
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for frame in frames:
            # Handed on in pieces, so that texts are not held twice.
            for first in range(0, len(frame), SCORED_AT_ONCE):
                piece = frame.iloc[first : first + SCORED_AT_ONCE]
                measures = np.array([measured(folded(t), automaton) for t in piece["text"]]).reshape(-1, 2)
                yield piece.assign(**{column: lexicon.score(measures)})

    return score


def toxicity(docs: DataFrame, lexicon: Lexicon, keep: list[str] | None = None, column: str = "score") -> DataFrame:
    """The columns ``keep`` of every row (all of them by default) and ``column``, its score from 0 to 1.

    Texts are folded and matched against the lexicon in one pass, whatever its size.  A term
    counts at the start of a word and outside of the exception phrases.  The score follows the
    weight of all terms, and that weight by length.  Only the text takes part.

    A null text counts as empty and gets the score of a text without terms.  Repeated rows get
    the same score; an empty table gives no rows.  A column of that name is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != column.lower()]
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    scored = rows.mapInPandas(_score(lexicon, column), rows.withColumn(column, F.lit(0.0)).schema)
    return scored.select(*keep, column)


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted`` (1 from a score of 0.5)."""
    return toxicity(docs, fit_lexicon(docs, labels), ["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted to be toxic, with their own columns."""
    (score,) = unused(docs.columns, "score")
    return toxicity(docs, fit_lexicon(docs, labels), column=score).where(F.col(score) < 0.5).select(*docs.columns)
