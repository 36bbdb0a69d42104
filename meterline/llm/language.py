"""Language identification by multilingual mixtures.

Every language has a distribution over hashed byte trigrams of lower-case words, counted over all
learning rows. A document is a mixture of languages: expectation-maximisation finds the proportions
that make its words likeliest, each word being of one language. Sets of languages are compared by
likelihood less a penalty for each member; the set's largest proportion gives the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import pieces
from meterline.llm.words import LETTERS, Words, words_of

BUCKETS = 1 << 16
#: A model row for each language comes to the driver, so their number has to be bounded.
MOST_LANGUAGES = 1000
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    logs: np.ndarray  # trigram buckets by languages


def _trigrams(words: Words) -> np.ndarray:
    """A bucket for each letter byte: it and its neighbours, a word's border being 0."""
    inside = np.flatnonzero(words.data)
    x = np.concatenate(([0], words.data, [0])).astype(np.uint32)
    code = x[inside] | x[inside + 1] << np.uint32(8) | x[inside + 2] << np.uint32(16)
    return (code * np.uint32(2654435761)) >> np.uint32(16)


def fit(labelled: DataFrame, smoothing: float = 0.05) -> Model:
    """Learn from the rows (lang, text) in which neither is null. Without any, the model knows no language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, own in batch.groupby("lang", sort=False)["text"]:
                texts = own.tolist()
                into = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for a, b in pieces(texts):
                    into += np.bincount(_trigrams(words_of(texts[a:b], LETTERS)), minlength=BUCKETS)
        for lang, n in totals.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": n[at]})

    rows = labelled.select("lang", F.lower("text").alias("text")).dropna()
    counts = rows.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.limit(MOST_LANGUAGES * BUCKETS + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    n = np.zeros((BUCKETS, max(1, len(languages))))
    n[found["bucket"], found["lang"].map({x: i for i, x in enumerate(languages)})] = found["n"]
    return Model(languages, np.log((n + smoothing) / (n.sum(axis=0) + smoothing * BUCKETS)).astype(np.float32))


def _mixture(likely: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int):
    """Proportions of the allowed languages and log likelihoods, by document. likely: of words, relative."""
    count = np.diff(np.append(first, len(doc)))[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        weighted = likely * share[doc]
        weighted /= weighted.sum(axis=1, keepdims=True)
        share = np.add.reduceat(weighted, first) / count
        share[share < 1e-9] = 0
        share /= share.sum(axis=1, keepdims=True)
    return share, np.add.reduceat(np.log((likely * share[doc]).sum(axis=1)), first)


def mixtures(texts: list[str], model: Model, rounds: int, penalty: float, least: float):
    """For each text the proportions of its chosen languages, all 0 without words."""
    out = np.zeros((len(texts), len(model.languages)))
    words = words_of(texts, LETTERS)
    if not len(words.starts) or not model.languages:
        return out
    lengths = words.ends - words.starts
    logs = np.add.reduceat(model.logs[_trigrams(words)], np.cumsum(lengths) - lengths).astype(np.float64)
    likely = np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -60))
    docs, first, doc, n = np.unique(words.doc, return_index=True, return_inverse=True, return_counts=True)
    share, _ = _mixture(likely, doc, first, np.ones((len(docs), likely.shape[1])), rounds)
    order = np.argsort(-share, axis=1, kind="stable")
    chosen = np.zeros_like(share)
    np.put_along_axis(chosen, order[:, :1], 1, axis=1)
    # only documents with a second language of some weight can gain from a larger set
    for k in range(2, likely.shape[1] + 1):
        open_ = np.flatnonzero(np.take_along_axis(share, order[:, k - 1 : k], 1)[:, 0] >= least)
        if not len(open_):
            break
        row = np.isin(doc, open_)
        at, from_, inner = np.unique(doc[row], return_index=True, return_inverse=True)
        wider = np.zeros((len(at), likely.shape[1]))
        np.put_along_axis(wider, order[at, :k], 1, axis=1)
        _, before = _mixture(likely[row], inner, from_, (chosen[at] > 0).astype(float), rounds)
        found, after = _mixture(likely[row], inner, from_, wider, rounds)
        better = after - before > penalty * np.log1p(n[at]) * (k - (chosen[at] > 0).sum(axis=1))
        chosen[at[better]] = found[better]
    out[docs] = chosen
    return out


def predict(
    documents: DataFrame, model: Model, rounds: int = 12, penalty: float = 3.0, least: float = 0.02
) -> DataFrame:
    """Rows (doc_id, lang_pred, score, langs, shares), one for each row of (doc_id, text).

    `langs` are the chosen languages, `shares` their proportions, the largest first; lang_pred and score are the
    first of each, ties going to the language that sorts first. A text that is null, empty or without a letter, and any
    text if no language is known, is `und` with score 0 and no languages. Whole texts count, other columns don't.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            runs = [mixtures(texts[a:b], model, rounds, penalty, least) for a, b in pieces(texts)]
            share = np.concatenate(runs) if runs else np.zeros((0, len(model.languages)))
            order = np.argsort(-share, axis=1, kind="stable")
            langs = [[model.languages[j] for j in o if s[j] > 0] for o, s in zip(order, share, strict=True)]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "lang_pred": [x[0] if x else UNKNOWN for x in langs],
                    "score": np.minimum(share.max(axis=1), 1.0) if share.shape[1] else 0.0,
                    "langs": langs,
                    "shares": [[float(s[j]) for j in o if s[j] > 0] for o, s in zip(order, share, strict=True)],
                }
            )

    rows = documents.select("doc_id", lettered().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(judge, f"doc_id {kind}, lang_pred string, score double, langs array<string>, shares array<double>")


def lettered() -> Column:
    """What is read of a text: all of it in lower case if it has a letter, else nothing."""
    return F.when(F.col("text").rlike(r"\p{L}"), F.lower("text")).otherwise("")


def identified(documents: DataFrame, model: Model, rounds: int = 12, penalty: float = 3.0, least: float = 0.02) -> DataFrame:
    """The rows, with all their columns, for which `predict` knows a language. Rows are judged where they are read."""

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            found = [mixtures(texts[a:b], model, rounds, penalty, least).any(axis=1) for a, b in pieces(texts)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0, bool))

    return documents.where(known(lettered()))
