"""Quality of documents from heuristics that overlap and err: a weak-label model, and a linear scorer trained by it.

Labellers vote good, bad or nothing for a document. Documents are counted by their pattern of votes, and
expectation-maximisation finds how often each labeller votes what for good and for bad documents, and the share of good
ones; no true label is needed. The patterns' posterior chances then are the labels that a logistic regression on hashed byte
n-grams learns from, so that it also judges texts on which no labeller is sure.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm import linear
from meterline.llm.common import pieces, stored
from meterline.llm.words import ALNUM, words_of

#: name, and what votes bad (from the first value on) and good (up to the second). Fixed values.
LABELLERS = (
    ("symbols", 0.15, 0.02),  # signs such as # $ % & * ! | for each word
    ("sign_runs", 0.1, 0.01),  # the same sign twice in a row, for each word
    ("capitals", 0.5, 0.15),  # of ASCII letters
    ("repeats", 0.3, 0.03),  # words that are the same as the one before
    ("stutter", 0.5, 0.1),  # of runs of three words, those met before in the text
    ("pipes", 0.2, 0.01),  # bars for each word
    ("long_words", 14.0, 9.0),  # mean bytes of a word
    ("no_stops", 60.0, 20.0),  # words for each full stop, comma or line end
    ("digits", 0.2, 0.02),  # of letters and digits
)
BAD, NONE, GOOD = "0", "-", "1"
GRAMS = (3, 4)
BUCKETS = 1 << 15
#: Documents the scorer is fitted on, at most: those whose ids have the smallest hashes.
SAMPLE = 3000
_SIGNS = np.isin(np.arange(256), [ord(c) for c in "#$%&*!|=<>{}[]^~@\\"])
_STOPS = np.isin(np.arange(256), [ord(c) for c in ".,;:?\n"])


def measures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n x labellers values, and the number of words."""
    n = len(texts)
    words = words_of(texts, ALNUM)
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\0".join(coded) + b"\0", np.uint8)
    doc = np.repeat(np.arange(n), [len(c) + 1 for c in coded])
    count = np.bincount(words.doc, minlength=n)
    each = np.maximum(count, 1)

    def per(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n)

    capital, digit = (raw >= 65) & (raw <= 90), (raw >= 48) & (raw <= 57)
    small, upper_half = (raw >= 97) & (raw <= 122), raw >= 128
    letters = per(capital) + per(small)
    h, d = words.hashes, words.doc
    again = np.flatnonzero((h[1:] == h[:-1]) & (d[1:] == d[:-1]))
    three = np.zeros(n)
    if len(h) > 2:
        run = (h[2:] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[:-2] * np.uint64(7))[d[2:] == d[:-2]]
        of = d[2:][d[2:] == d[:-2]]
        order = np.lexsort((run, of))
        same = np.flatnonzero((run[order][1:] == run[order][:-1]) & (of[order][1:] == of[order][:-1]))
        three = np.bincount(of[order][1:][same], minlength=n) / np.maximum(np.bincount(of, minlength=n), 1)
    values = (
        per(_SIGNS[raw]) / each,
        np.bincount(doc[1:][(raw[1:] == raw[:-1]) & _SIGNS[raw[1:]]], minlength=n) / each,
        per(capital) / np.maximum(letters, 1),
        np.bincount(d[1:][again], minlength=n) / each if len(h) else np.zeros(n),
        three,
        per(raw == ord("|")) / each,
        np.bincount(d, words.ends - words.starts, minlength=n) / each,
        count / np.maximum(per(_STOPS[raw]), 1),
        per(digit) / np.maximum(letters + per(digit) + per(upper_half), 1),
    )
    return np.stack(values, axis=1), count


def patterns(texts: list[str]) -> list[str]:
    """A sign for each labeller. All are silent on a text without words."""
    values, count = measures(texts)
    bad, good = (np.array([x[k] for x in LABELLERS]) for k in (1, 2))
    signs = np.where(values >= bad, BAD, np.where(values <= good, GOOD, NONE))
    signs[count == 0] = NONE
    return ["".join(s) for s in signs]


class Labels(NamedTuple):
    prior: float
    chances: np.ndarray  # labellers x votes (bad, none, good) x classes (bad, good)

    def posterior(self, votes: list[str]) -> np.ndarray:
        """Chance of each pattern to be of a good document; without any vote, the prior."""
        if not len(votes):
            return np.zeros(0)
        at = np.array([["0-1".index(s) for s in v] for v in votes])
        logs = np.log(self.chances)[np.arange(at.shape[1]), at]
        logs = np.where((at == 1)[:, :, None], 0.0, logs).sum(axis=1) + np.log([1 - self.prior, self.prior])
        return linear.chance(logs[:, 1] - logs[:, 0])


def label_model(counts: pd.DataFrame, rounds: int = 50) -> Labels:
    """Expectation-maximisation over counted patterns (votes, n), beginning with each pattern's majority.

    There are at most 3 to the power of the labellers patterns, however many documents. A silent labeller says nothing.
    """
    m = len(LABELLERS)
    votes, n = counts["votes"].tolist(), counts["n"].to_numpy(float)
    at = np.array([["0-1".index(s) for s in v] for v in votes]).reshape(-1, m)
    # one bad vote outweighs several good ones at the start: each labeller looks at one fault only
    good = np.where((at == 0).any(axis=1), 0.1, np.where((at == 2).any(axis=1), 0.9, 0.5))
    model = Labels(0.5, np.full((m, 3, 2), 1 / 3))
    for _ in range(rounds):
        mass = np.stack((n * (1 - good), n * good), axis=1)
        chances = np.stack([np.stack([mass[at[:, j] == v].sum(axis=0) for v in range(3)]) for j in range(m)]) + 1.0
        # labellers are taken to be right more often than not
        chances /= chances.sum(axis=1, keepdims=True)
        prior = float((mass[:, 1].sum() + 1) / (mass.sum() + 2))
        model = Labels(prior, chances)
        good = model.posterior(votes)
    return model


def vote(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, text, votes)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            batch["votes"] = [v for a, b in pieces(texts) for v in patterns(texts[a:b])]
            yield batch

    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(read, f"doc_id {kind}, text string, votes string")


def classify(documents: DataFrame, sample: int = SAMPLE, keep_from: float = 0.5) -> DataFrame:
    """Rows (doc_id, votes, weak_label, score, keep), one for each row of (doc_id, text).

    `weak_label` is the label model's chance that the document is good, `score` the mean of it and the scorer's chance, and
    `keep` is whether score is at least `keep_from`. Null and empty texts and texts without words have no votes and score
    0. The label model counts all documents; the scorer learns from at most `sample` of them.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = stored(vote(rows).groupBy("votes").agg(F.count("*").alias("n")), "votes")
    labels = label_model(counts.where(F.col("votes") != NONE * len(LABELLERS)).toPandas())

    def features(texts: list[str]):
        return linear.hashed_grams([t.encode("utf-8", "surrogatepass") for t in texts], GRAMS, BUCKETS)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in pieces(texts, 1 << 18):
                row, feature, value = features(texts[a:b])
                cut = np.searchsorted(row, np.arange(1, b - a))
                yield pd.DataFrame(
                    {
                        "target": labels.posterior(patterns(texts[a:b])),
                        "feature": [x.astype(np.int32).tobytes() for x in np.split(feature, cut)],
                        "value": [x.astype(np.float32).tobytes() for x in np.split(value, cut)],
                    }
                )

    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    some = rows.join(F.broadcast(ids), "doc_id").mapInPandas(learn, "target double, feature binary, value binary").limit(sample).toPandas()
    feature = [np.frombuffer(x, np.int32) for x in some["feature"]]
    row = np.repeat(np.arange(len(some)), [len(x) for x in feature])
    if len(row):
        value = np.concatenate([np.frombuffer(x, np.float32) for x in some["value"]])
        weight, bias = linear.fit(row, np.concatenate(feature), value, some["target"].to_numpy(), BUCKETS)
    else:
        weight, bias = np.zeros(BUCKETS), 0.0

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in pieces(texts, 1 << 18):
                votes = patterns(texts[a:b])
                weak = labels.posterior(votes)
                own = linear.chance(linear.score(*features(texts[a:b]), weight, bias, b - a))
                score = np.where(measures(texts[a:b])[1] > 0, (weak + own) / 2, 0.0)
                yield pd.DataFrame(
                    {"doc_id": batch["doc_id"].iloc[a:b], "votes": votes, "weak_label": weak, "score": score, "keep": score >= keep_from}
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(judge, f"doc_id {kind}, votes string, weak_label double, score double, keep boolean")
