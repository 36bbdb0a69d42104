"""Exact search for the largest inner products of whole numbers, by bounds of segments, coarse to fine.

A vector is cut in segments of length l, of which mean m and deviation s are kept. For two vectors the squared distance
is at least the sum over segments of l ((m - m')^2 + (s - s')^2). As the inner product is half of |x|^2 + |y|^2 less the
squared distance, and |x|^2 is the sum of l (m^2 + s^2), it is at most the sum of l (m m' + s s'). Rows whose bound with few
segments is below what the query has already are dropped, the rest is bounded with more segments, and survivors are
multiplied out. Nothing is approximate: the bounds only spare work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored
from meterline.llm.vectors import best, first_copies, usable

LEVELS = (4, 16)  # segments, coarse to fine
BLOCK = 2048
CHUNK = 512
#: Blocks or chunks in one file, the least that a task reads.
TOGETHER = 4


def _bounds(x: np.ndarray) -> list[np.ndarray]:
    return [_bounds_by(x, n) for n in LEVELS]


def _bounds_by(x: np.ndarray, segments: int) -> np.ndarray:
    """For each vector l^0.5 times the means and deviations of its segments: their products bound inner products."""
    edges = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    parts = [x[:, a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    means = np.stack([p.mean(axis=1) * np.sqrt(p.shape[1]) for p in parts], axis=1)
    spread = np.stack([p.std(axis=1) * np.sqrt(p.shape[1]) for p in parts], axis=1)
    return np.hstack((means, spread))


def _whole(one: np.ndarray, rows: np.ndarray) -> bool:
    """Whether doubles hold the inner products, as no partial sum passes 2^53."""
    return not rows.size or np.abs(rows).max() * np.abs(one).max(initial=0) * rows.shape[1] < 2.0**53


def _products(one: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, in Python's integers if doubles don't hold them."""
    if not _whole(one, rows):
        return np.array([sum(int(v) * int(w) for v, w in zip(one[a], rows[b], strict=True)) for a, b in zip(i, j, strict=True)] + [0], object)[:-1]
    cuts = range(0, len(i), 1 << 16)
    parts = [np.einsum("ij,ij->i", one[i[a : a + (1 << 16)]], rows[j[a : a + (1 << 16)]]) for a in cuts]
    return np.concatenate([*parts, np.zeros(0)]).astype(np.int64)


def _search(
    one: np.ndarray, ask: list[np.ndarray], own: np.ndarray, rows: np.ndarray, have: list[np.ndarray], ids: np.ndarray, least: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    """Of each query the best k of the block's rows that reach `least`, as places of queries and rows and their products.

    `ask` and `have` are the bounds of both. Where many pairs are open, a product of all costs less than one of those picked out.
    """
    # room for rounding: products of doubles, whose sum has a relative error of some 1e-13
    slack = 1 + 1e-9 * np.outer(np.linalg.norm(one, axis=1), np.linalg.norm(rows, axis=1)).max(axis=1, initial=0)
    bound = ask[0] @ have[0].T
    itself = ids == own[:, None]
    bound[itself] = -np.inf
    if len(ids) > k and np.isneginf(least).any():
        first = np.argpartition(bound, -k, axis=1)[:, -k:]
        score = _products(one, rows, np.repeat(np.arange(len(own)), k), first.ravel()).reshape(-1, k).astype(float)
        score[np.take_along_axis(itself, first, axis=1)] = -np.inf
        least = np.maximum(least, score.min(axis=1))
    enough = (least - slack)[:, None]
    left = (bound >= enough) & ~itself
    dense = left.size // 16
    for a, h in zip(ask[1:], have[1:], strict=True):
        if np.count_nonzero(left) > dense:
            left &= a @ h.T >= enough
        else:
            i, j = np.nonzero(left)
            left[i, j] = np.einsum("ij,ij->i", a[i], h[j]) >= enough[i, 0]
    if np.count_nonzero(left) > dense and _whole(one, rows):
        left &= one @ rows.T >= least[:, None]
    i, j = np.nonzero(left)
    score = _products(one, rows, i, j)
    at = np.flatnonzero(score.astype(float) >= least[i])  # rounded alike on both sides, so none that is equal is lost
    at = at[np.lexsort((ids[j[at]], -score[at], i[at]))]
    start = np.searchsorted(i[at], np.arange(len(own)))
    at = at[np.arange(len(at)) - start[i[at]] < k]
    return i[at], j[at], score[at]


def _packed(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Blocks of about `size` vectors, each a row (key, ids, data)."""
    blocks = max(1, -(-rows.count() // size))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        data = np.stack(block["v"].to_list())
        return pd.DataFrame({key: [block[key].iat[0]], "ids": [block["vec_id"].to_numpy(np.int64).tobytes()], "data": [data.tobytes()]})

    dealt = rows.withColumn(key, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).repartition(-(-blocks // TOGETHER), key)
    return stored(dealt.groupBy(key).applyInPandas(pack, f"{key} int, ids binary, data binary"), key)


def top_products(embeddings: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each vec_id divisible by `every` its k largest inner products.

    Components are floor(scale * x), and the score is the exact product of these whole numbers, held to the range of a long.
    See `vectors.usable` for the rows that take part. Fewer than k candidates are all returned; equal scores go to the
    smaller vec_id. Queries and rows meet as blocks, in a task for each pair of files of them: neither is broadcast or shuffled, and
    a task holds the queries of its files and some blocks at a time.
    """
    rows = stored(usable(embeddings, F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))), "whole")
    blocks = _packed(first_copies(rows, k), "block", BLOCK).select("ids", "data")
    chunks = _packed(rows.where(F.col("vec_id") % every == 0), "chunk", CHUNK).select(F.col("ids").alias("own"), F.col("data").alias("one"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reached: dict[bytes, np.ndarray] = {}  # for each chunk the k largest products of its queries so far
        asked: dict[bytes, list[np.ndarray]] = {}
        last, have = None, []
        for batch in batches:
            for own, one, ids, data in batch[["own", "one", "ids", "data"]].itertuples(index=False):
                chunk, block, own, ids = own, ids, np.frombuffer(own, np.int64), np.frombuffer(ids, np.int64)
                one, data = (np.frombuffer(x, np.float64).reshape(len(i), -1) for x, i in ((one, own), (data, ids)))
                if block != last:
                    last, have = block, _bounds(data)
                if chunk not in asked:
                    asked[chunk], reached[chunk] = _bounds(one), np.full((len(own), k), -np.inf)
                so_far = reached[chunk]
                i, j, score = _search(one, asked[chunk], own, data, have, ids, so_far.min(axis=1), k)
                more = np.full((len(own), k), -np.inf)
                more[i, np.arange(len(i)) - np.searchsorted(i, i)] = score.astype(float)
                reached[chunk] = np.sort(np.hstack((so_far, more)), axis=1)[:, -k:]
                held = [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in score]
                yield pd.DataFrame({"query_id": own[i], "vec_id": ids[j], "score": np.array(held, np.int64)})

    pairs = blocks.crossJoin(chunks.hint("shuffle_replicate_nl"))  # else the smaller side goes through the driver
    met = pairs.mapInPandas(meet, "query_id long, vec_id long, score long")
    return best(met, k)
