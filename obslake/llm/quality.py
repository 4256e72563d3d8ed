"""Quality classifier: heuristic labellers weighed by expectation-maximisation teach a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from obslake.llm.hashing import LOWER, NOT_SPACE, U64, Rolling, joined, mix, packs
from obslake.session import cut_lineage

# At most this many rows, taken by a hash of id and text, train the linear scorer.
TRAIN_ROWS = 10_000
BUCKETS = 1 << 16
STEPS = 60
TRUST = 1.0

GOOD, BAD, ABSTAIN = 2, 0, 1

# Bytes by class: letters, capitals, digits, beyond ASCII, sentence signs, other signs.
_CLASS = np.full(256, ord("#"), dtype=np.uint8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = ord("a"), ord("A"), ord("0"), ord("a")
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = ord(".")
_CLASS[~NOT_SPACE] = ord(" ")


@dataclass
class Pack:
    """Words of several texts: their hashes, the hashes of their shapes, and what the labellers look at."""

    at: np.ndarray
    hashes: np.ndarray
    shapes: np.ndarray
    measures: dict[str, np.ndarray]


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[at[1:]] - sums[at[:-1]]


def _most_frequent(texts: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text how often its most frequent key occurs, and how many keys it has."""
    most, distinct = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if len(keys):
        order = np.lexsort((keys, texts))
        texts, keys = texts[order], keys[order]
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1]))))
        np.maximum.at(most, texts[first], np.diff(np.concatenate((first, [len(keys)]))))
        distinct = np.bincount(texts[first], minlength=n)
    return most, distinct


def read(texts: list[bytes]) -> Pack:
    raw, offsets = joined(texts)
    inside = NOT_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
    starts, ends = edges[0::2], edges[1::2]
    hashes = Rolling(LOWER[raw]).of(starts, ends)
    kinds = _CLASS[raw]
    # The shape of a word: the classes of its first byte and its last four.
    shapes = mix(Rolling(kinds).of(np.maximum(starts, ends - 4), ends) + kinds[starts].astype(U64))
    at = np.searchsorted(starts, offsets)
    n, text_of = len(texts), np.repeat(np.arange(len(texts)), np.diff(at))
    count = np.maximum(1, np.diff(at))
    letters = np.maximum(1, _per_text((kinds == ord("a")) | (kinds == ord("A")), offsets))
    most, distinct = _most_frequent(text_of, hashes, n)
    breaks = np.flatnonzero(raw == 10)
    line_starts = np.concatenate(([0], breaks[:-1] + 1))
    full = breaks - line_starts > 0
    line_text = np.searchsorted(offsets, line_starts[full], side="right") - 1
    _, lines = _most_frequent(line_text, Rolling(raw).of(line_starts[full], breaks[full]), n)
    n_lines = np.bincount(line_text, minlength=n)
    ends_well = np.isin(raw[ends - 1], [ord(c) for c in ".?"])
    return Pack(
        at,
        hashes,
        shapes,
        {
            "words": np.diff(at).astype(float),
            "signs": _per_text(kinds == ord("#"), offsets) / np.maximum(1, _per_text(inside, offsets)),
            "capitals": _per_text(kinds == ord("A"), offsets) / letters,
            "repeated": most / count,
            "variety": distinct / count,
            "lines_again": 1 - lines / np.maximum(1, n_lines),
            "again": _per_text(np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1]))), at) / count
            if len(hashes)
            else np.zeros(n),
            "sentences": _per_text(ends_well, at) / count,
        },
    )


def votes_of(pack: Pack) -> np.ndarray:
    """A row per text, a column per labeller: good, bad or abstaining."""
    m = pack.measures

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN)).astype(np.int64)

    return np.stack(
        [
            vote(m["signs"] > 0.08, m["signs"] < 0.02),
            vote(m["capitals"] > 0.4, m["capitals"] < 0.12),
            vote((m["repeated"] > 0.3) & (m["words"] >= 8), (m["repeated"] < 0.12) & (m["words"] >= 20)),
            vote((m["variety"] < 0.15) & (m["words"] < 4000) & (m["words"] >= 20), m["variety"] > 0.3),
            vote(m["lines_again"] > 0.3, m["lines_again"] < 0.05),
            vote(m["words"] < 4, m["words"] > 40),
            vote((m["again"] > 0.2) & (m["words"] >= 8), (m["again"] < 0.05) & (m["words"] >= 8)),
            vote((m["sentences"] < 0.01) & (m["words"] >= 60), (m["sentences"] > 0.04) & (m["sentences"] < 0.4)),
        ],
        axis=1,
    )


LABELLERS = 8
_BASE = 3 ** np.arange(LABELLERS)


@dataclass
class LabelModel:
    """Share of good texts, and for each labeller that does not abstain the chance of each vote given a bad or a good text."""

    good: float
    chances: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log(np.maximum(self.chances, 1e-300))
        logs[:, :, ABSTAIN] = 0.0
        at = np.arange(votes.shape[1])
        bad = np.log(1 - self.good) + logs[at, 0, votes].sum(axis=1)
        good = np.log(self.good) + logs[at, 1, votes].sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))


def fit_label_model(patterns: dict[int, int], trust: float = TRUST, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns; it starts from who has an objection.

    Labellers count as independent given the label.  Chances carry one pseudo-count per vote, and
    a labeller is trusted not to object to good texts by ``trust`` pseudo-votes per text.
    """
    if not patterns:
        return LabelModel(0.5, np.full((LABELLERS, 2, 3), 1 / 3))
    votes = np.array(list(patterns))[:, None] // _BASE % 3
    counts = np.array(list(patterns.values()), dtype=float)
    # One clear objection outweighs the other votes at the start.
    posterior = np.clip(0.9 - 0.8 * (votes == BAD).any(axis=1), 0.02, 0.98)
    for _ in range(rounds):
        chances = np.ones((LABELLERS, 2, 3))
        for k in range(LABELLERS):
            chances[k, 1] += np.bincount(votes[:, k], counts * posterior, minlength=3)
            chances[k, 0] += np.bincount(votes[:, k], counts * (1 - posterior), minlength=3)
        chances[:, 1, GOOD] += trust * counts.sum()
        # Abstaining says nothing.
        chances[:, :, ABSTAIN] = 0
        chances /= chances.sum(axis=2, keepdims=True)
        good = (counts @ posterior + 1) / (counts.sum() + 2)
        before, posterior = posterior, LabelModel(good, chances).posterior(votes)
        if np.abs(posterior - before).max() < 1e-9:
            break
    return LabelModel(float(good), chances)


def _features(pack: Pack) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of each text, of length 1: words, word shapes, and steps of variety, repetition and length."""
    found = []
    m = pack.measures
    steps = [np.floor(10 * m["variety"]), np.floor(10 * m["again"]) + 100, np.floor(np.log2(1 + m["words"])) + 200,
             np.floor(20 * m["signs"]) + 300, np.floor(10 * m["capitals"]) + 400, np.floor(10 * m["lines_again"]) + 500]
    steps = mix(np.stack(steps, axis=1).astype(U64) + U64(1 << 40))
    for i, (a, b) in enumerate(zip(pack.at[:-1], pack.at[1:])):
        kinds = []
        for own, weight in ((pack.hashes[a:b], 1.0), (pack.shapes[a:b], 2.0), (steps[i], 1.0)):
            index, n = np.unique(own % U64(BUCKETS), return_counts=True)
            value = np.sqrt(n)
            norm = np.sqrt((value**2).sum()) or 1.0
            kinds.append((index.astype(np.int64), weight * value / norm))
        found.append((np.concatenate([k[0] for k in kinds]), np.concatenate([k[1] for k in kinds]) / np.sqrt(6)))
    return found


def _encoded(frame: pd.DataFrame) -> list[bytes]:
    return [(t or "").encode() for t in frame["text"]]


def _patterns(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        codes = [votes_of(read(p)) @ _BASE for _, p in packs(_encoded(frame))]
        values, n = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, int),) * 2
        yield pd.DataFrame({"pattern": values, "n": n})


def _training(model: LabelModel):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for _, texts in packs(_encoded(frame)):
                pack = read(texts)
                for (index, value), y in zip(_features(pack), model.posterior(votes_of(pack))):
                    out.append((0, float(y), index.astype(np.int32).tobytes(), value.astype(np.float32).tobytes()))
            yield pd.DataFrame(out, columns=["one", "label", "places", "amounts"])

    return rows


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    """Logistic regression on soft labels by AdaGrad over all given rows, with a small ridge."""
    rows = rows.sort_values(["label", "places"], ignore_index=True)
    places = [np.frombuffer(p, dtype=np.int32) for p in rows["places"]]
    lengths = np.array([len(p) for p in places])
    places = np.concatenate(places).astype(np.int64)
    amounts = np.concatenate([np.frombuffer(a, dtype=np.float32) for a in rows["amounts"]]).astype(np.float64)
    owner, y = np.repeat(np.arange(len(rows)), lengths), rows["label"].to_numpy()
    weights, seen, bias, bias_seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8), 0.0, 1e-8
    for _ in range(STEPS):
        z = np.bincount(owner, amounts * weights[places], minlength=len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gradient = np.bincount(places, amounts * error[owner], minlength=BUCKETS) / len(rows) + 1e-6 * weights
        seen += gradient**2
        weights -= 0.5 * gradient / np.sqrt(seen)
        bias_seen += error.mean() ** 2
        bias -= 0.5 * error.mean() / np.sqrt(bias_seen)
    return pd.DataFrame({"bias": [bias], "weights": [weights.tobytes()]})


@dataclass
class QualityModel:
    labels: LabelModel
    bias: float
    weights: np.ndarray


def fit_quality(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> QualityModel:
    """The label model from the votes on all rows, and the linear scorer from at most ``train_rows`` of them.

    Votes are counted by pattern before they are gathered: there are 3^8 patterns whatever the
    number of rows.  The scorer is trained in one task on a bounded number of rows, taken by a
    hash of id and text, whose labels are the posteriors of their votes.
    """
    texts = docs.select("text")
    found = texts.mapInPandas(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    labels = fit_label_model({r.pattern: r.n for r in found})
    total = sum(r.n for r in found)
    if not total:
        return QualityModel(labels, 0.0, np.zeros(BUCKETS))
    # About as many rows as wanted pass the hash; the limit holds in any case.
    share = min(1.0, 1.5 * train_rows / total)
    order = F.xxhash64("doc_id", "text")
    near = docs.select("text", order.alias("order")).where(F.pmod("order", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = cut_lineage(near.orderBy("order").limit(train_rows).select("text"))
    rows = sample.mapInPandas(_training(labels), "one int, label double, places binary, amounts binary")
    trained = rows.groupBy("one").applyInPandas(_train, "bias double, weights binary").first()
    return QualityModel(labels, trained.bias, np.frombuffer(bytes(trained.weights)))


def _score(model: QualityModel):
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores, posteriors = [], []
            for _, texts in packs(_encoded(frame)):
                pack = read(texts)
                posteriors.append(model.labels.posterior(votes_of(pack)))
                z = np.array([v @ model.weights[i] for i, v in _features(pack)]) + model.bias
                scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            frame = frame.drop(columns="text")
            yield frame.assign(
                score=np.concatenate(scores) if scores else np.zeros(0),
                posterior=np.concatenate(posteriors) if posteriors else np.zeros(0),
            )

    return score


def quality_table(docs: DataFrame, model: QualityModel | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``score`` (0 to 1, higher: better), ``posterior`` of the labellers, ``predicted`` (1 from 0.5).

    Whole texts are read; only the text takes part.  A null text counts as empty, and an empty
    text is judged by its votes like any other.  Repeated rows get the same score; an empty table
    gives no rows.  Other columns do not matter.
    """
    model = model or fit_quality(docs)
    scored = docs.select("doc_id", "text").mapInPandas(_score(model), "doc_id long, score double, posterior double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int"))
