"""URL filter: rules first, and where none fits a logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm import linear

GRAMS = (3, 4, 5)
BUCKETS = 1 << 14
#: Labelled rows that the regression is fitted on, at most: those whose hashes are smallest.
SAMPLE = 8000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules(lines: Sequence[str]) -> list[Rule]:
    """From lines such as `block example.com/en/`."""
    parts = [line.split(" ", 1) for line in lines]
    return [Rule(v, t[: t.index("/")], t[t.index("/") :]) for v, t in parts]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, known: Sequence[Rule], field: str) -> Column:
    """A field of the longest rule that fits, null if none does."""
    out = F.when(F.lit(False), "")
    for rule in sorted(known, key=lambda r: (-len(r.text), -len(r.host), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = out.when(fits, getattr(rule, field))
    return out


def _features(host: pd.Series, path: pd.Series):
    texts = [b"\1" + h.encode("utf-8", "surrogatepass") + b"\2" + p.encode("utf-8", "surrogatepass") + b"\3" for h, p in zip(host, path, strict=True)]
    return linear.hashed_grams(texts, GRAMS, BUCKETS)


class Model(NamedTuple):
    weight: np.ndarray
    bias: float


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows (host, path, allowed); `allowed` is a boolean. At most `sample` rows are used.

    They are those with the smallest hash of host and path. Without rows every url is allowed.
    """
    rows = labelled.select("host", "path", F.col("allowed").cast("double").alias("allowed")).dropna()
    order = F.xxhash64("host", "path")
    few = rows.orderBy(order, "host", "path", "allowed").limit(sample).toPandas()
    if few.empty:
        return Model(np.zeros(BUCKETS), 1.0)
    target = few["allowed"].to_numpy()
    return Model(*linear.fit(*_features(few["host"], few["path"]), target, BUCKETS))


def judge(pages: DataFrame, known: Sequence[Rule], model: Model | None = None) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, chance), one for each row of (page_id, url).

    `rule` is the text of the longest rule that fits, else null; `chance` is the regression's chance that the url is
    allowed, and decides from 0.5 on where no rule fits. Without a model one is fitted on the urls that have a rule. A
    null url and one without `://` have an empty host and path, fit no rule, and are judged by the regression.
    """
    host, path = F.col("host"), F.col("path")
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = split.select("*", *(best_rule(host, path, known, f).alias(n) for f, n in (("text", "rule"), ("verdict", "verdict"))))
    if model is None:
        model = fit(ruled.where("rule IS NOT NULL").select("host", "path", (F.col("verdict") == "allow").alias("allowed")))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = linear.score(*_features(batch["host"], batch["path"]), model.weight, model.bias, len(batch))
            batch["chance"] = linear.chance(x)
            by_model = np.where(batch["chance"] >= 0.5, "allow", "block")
            batch["verdict"] = batch["verdict"].where(batch["verdict"].notna(), by_model)
            yield batch

    kind = pages.schema["page_id"].dataType.simpleString()
    return ruled.mapInPandas(decide, f"page_id {kind}, host string, path string, rule string, verdict string, chance double")
