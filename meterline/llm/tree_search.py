"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample, and every vector is put in a leaf. A query visits leaves in the order in which a
priority queue of tree nodes gives them; how many is calibrated on the sample, by widening until the recall is reached.
Queries then meet the vectors of their leaves in a join on blocks of leaves, so no leaf has to fit in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored
from meterline.llm.vectors import best, first_copies, usable

SAMPLE = 8192
BRANCHES = 8
LEAF = 64  # sample vectors in a leaf, about
RECALL = 0.97
BLOCK = 2048


class Node(NamedTuple):
    centres: np.ndarray
    children: list  # of Node, or the number of a leaf


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8):
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.stack([np.bincount(own, x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres, (x @ centres.T).argmax(axis=1)


def grow(x: np.ndarray, seed: int = 7) -> tuple[Node, int]:
    """A tree of unit vectors, and how many leaves it has."""
    rng, leaves = np.random.default_rng(seed), iter(range(1 << 31))
    made = 0

    def split(rows: np.ndarray):
        nonlocal made
        k = min(BRANCHES, len(rows) // LEAF)
        if k >= 2:
            centres, own = _kmeans(x[rows], k, rng)
            used = np.unique(own)
            if len(used) > 1:
                return Node(centres[used], [split(rows[own == j]) for j in used])
        made += 1
        return next(leaves)

    root = split(np.arange(len(x)))
    return (root if isinstance(root, Node) else Node(np.zeros((1, x.shape[1])), [root])), made


def leaf_of(tree: Node, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)

    def sink(node, rows: np.ndarray) -> None:
        if not isinstance(node, Node):
            out[rows] = node
            return
        own = (x[rows] @ node.centres.T).argmax(axis=1)
        for j in np.unique(own):
            sink(node.children[j], rows[own == j])

    sink(tree, np.arange(len(x)))
    return out


def leaves_for(tree: Node, q: np.ndarray, most: int, sizes: np.ndarray | None = None, enough: int = 0) -> list[int]:
    """Leaves in the order of a queue by nearness: `most` of them, and more until they hold `enough` vectors by their sizes."""
    queue, order, out = [(0.0, 0, tree)], 0, []
    held = 0
    while queue and (len(out) < most or held < enough):
        _, _, node = heapq.heappop(queue)
        if not isinstance(node, Node):
            out.append(node)
            held += 0 if sizes is None else int(sizes[node])
            continue
        for near, child in zip((node.centres @ q).tolist(), node.children, strict=True):
            order += 1
            heapq.heappush(queue, (-near, order, child))
    return out


def visits_for(tree: Node, leaves: int, x: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
    """The fewest leaf visits with which the sample's own first vectors find enough of their neighbours in it."""
    some = min(queries, len(x))
    near = x[:some] @ x.T
    near[np.arange(some), np.arange(some)] = -2
    k = min(k, len(x) - 1)
    if k < 1:
        return leaves
    true = np.argpartition(-near, k - 1, axis=1)[:, :k]
    own = leaf_of(tree, x)
    hits = np.zeros(leaves + 1)
    for i in range(some):
        turn = {leaf: at for at, leaf in enumerate(leaves_for(tree, x[i], leaves), 1)}
        np.add.at(hits, [turn[own[t]] for t in true[i]], 1)
    return int(np.searchsorted(np.cumsum(hits) / (some * k), recall)) if hits.any() else leaves


def _cosines(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", rows, q) / (np.sqrt(np.einsum("ij,ij->i", rows, rows)) * np.sqrt(np.einsum("i,i->", q, q)))


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each vec_id divisible by `every` its k nearest by cosine, as found.

    See `vectors.usable` for the rows that take part; zero vectors don't either. Fewer than k candidates are all
    returned. Scores are cosines of the whole vectors in double precision; equal scores go to the smaller vec_id.
    """
    rows = usable(embeddings)
    rows = rows.where(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) > 0)
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    shape = "query_id long, rank int, vec_id long, score double"
    if few.empty:
        return embeddings.sparkSession.createDataFrame([], shape)
    x = _unit(np.stack(few["v"].to_list()))
    tree, leaves = grow(x)
    visits = max(1, min(leaves, visits_for(tree, leaves, x, k, recall) + 1))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["leaf"] = leaf_of(tree, _unit(np.stack(batch["v"].to_list())))
                yield batch

    def seek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["leaf"] = [leaves_for(tree, q, visits, sizes, k + 1) for q in _unit(np.stack(batch["v"].to_list()))]
                yield batch

    held = stored(first_copies(rows, k).mapInPandas(put, "vec_id long, v array<double>, leaf long"), "leaves")
    # one number for each leaf; a query goes on until its leaves hold k vectors beside its own
    sizes = np.zeros(leaves, np.int64)
    for leaf, n in held.groupBy("leaf").count().collect():
        sizes[leaf] = n
    asked = rows.where(F.col("vec_id") % every == 0).mapInPandas(seek, "vec_id long, v array<double>, leaf array<long>")
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), "v", F.explode("leaf").alias("leaf")), "visits")
    # a leaf's vectors and its visitors are dealt in blocks; there are as many rows here as leaves
    blocks = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    plan = F.broadcast(stored(blocks(held, "rows").join(blocks(asked, "askers"), "leaf"), "blocks"))
    part = lambda name, n: F.pmod(F.xxhash64(name), F.col(n)).cast("int")
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(plan, "leaf").select("leaf", "query_id", "v", part("query_id", "askers").alias("asker"), every_one("rows").alias("row"))
    right = held.join(plan, "leaf").select("leaf", "vec_id", "v", part("vec_id", "rows").alias("row"), every_one("askers").alias("asker"))

    def meet(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asking) and len(there):
            data, ids = np.stack(there["v"].to_list()), there["vec_id"].to_numpy()
            about = np.stack(asking["v"].to_list())
            rough = _unit(about) @ _unit(data).T
            for i, (own, q) in enumerate(zip(asking["query_id"], about, strict=True)):
                near = np.where(ids == own, -2, rough[i])
                least = np.partition(near, -k)[-k] if len(near) > k else -2
                at = np.flatnonzero((near >= least - 1e-12) & (ids != own))
                score = _cosines(q, data[at])
                top = np.lexsort((ids[at], -score))[:k]
                found.append(pd.DataFrame({"query_id": own, "vec_id": ids[at][top], "score": score[top]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    cell = ["leaf", "row", "asker"]
    met = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(meet, "query_id long, vec_id long, score double")
    return best(met, k)
