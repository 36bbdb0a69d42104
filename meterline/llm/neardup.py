"""Near-duplicates of documents by ProbMinHash.

A document is a set of shingles, runs of five words, weighted by how often they occur. The similarity of two is the
probability Jaccard: the sum over shared shingles d of 1 / sum over d' of max(x[d'] / x[d], y[d'] / y[d]); it is the
usual Jaccard where no shingle repeats. Each shingle is a Poisson process of arrivals whose rate is its weight, each
arrival falling in one of the signature's places; a place keeps the first to arrive. Processes stop once their next
arrival is later than any place's first. Two signatures agree in a place with the probability Jaccard as chance.

Signatures are cut in bands. Documents alike in a band are compared with hubs of that bucket, the members that share
the most buckets. What is still not connected there is compared in blocks by longer signatures, two bits a place, and
promising pairs are verified where they are found: a block gives only links that connect what it has not connected yet,
so fewer links than entries leave it, however many pairs are alike. Links are verified on whole texts.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import pieces, stored
from meterline.llm.components import components
from meterline.llm.words import mix, shingles_of, words_of

PLACES = 128
ROWS = 4  # places in a band: a pair at 0.8 shares none of the 32 bands in one of 2e7 cases
SHINGLE = 5
SIMILARITY = 0.8
#: A pair whose signatures agree in fewer places is not verified: at 0.8, 128 places do so in one of 1e7 cases.
LEAST_AGREEMENT = 0.6
HUB_ROUNDS = 2
#: Long signatures: their estimate is below this, for a pair at 0.8, in one of 1e10 cases.
LONG_PLACES = 1024
LEAST_ESTIMATE = 0.7
#: Entries of a bucket that are compared with each other at once.
BLOCK = 1024


def weighted_shingles(texts: list[str], size: int):
    """(document, shingle, weight) of all texts, by document and shingle, and the words they are from."""
    words = words_of(texts)
    doc, shingle = shingles_of(words, size)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return words, doc[at], shingle[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """n x places shingles: the first arrival in each place. Documents without a shingle keep zeros."""
    first = np.full(n * places, np.inf)
    winner = np.zeros(n * places, np.uint64)
    doc, time, made, burst = doc.astype(np.int64), np.zeros(len(doc)), 0, 1
    while len(doc):
        turn = np.arange(made, made + burst, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bits = mix(shingle[:, None] ^ mix(turn)[None, :])
        gaps = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        place = (doc[:, None] * places + (bits & np.uint64(places - 1)).astype(np.int64)).ravel()
        np.minimum.at(first, place, times.ravel())
        won = times.ravel() == first[place]
        winner[place[won]] = np.repeat(shingle, burst)[won]
        time, made = times[:, -1], made + burst
        still = time < first.reshape(n, places).max(axis=1)[doc]
        doc, shingle, weight, time = doc[still], shingle[still], weight[still], time[still]
        # the fewer are left, the more arrivals at once
        burst = min(64, max(1, 2 * burst)) if len(doc) < 20_000 else 1
    return winner.reshape(n, places)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in pieces(texts, 1 << 19):
            words, doc, shingle, weight = weighted_shingles(texts[a:b], SHINGLE)
            n = b - a
            sig = signatures(doc, shingle, weight, n)
            bands = np.zeros((n, PLACES // ROWS), np.uint64)
            for j in range(ROWS):
                bands = mix(bands ^ sig[:, j::ROWS]) + np.arange(PLACES // ROWS, dtype=np.uint64)
            count = np.bincount(words.doc, minlength=n)
            # two independent hashes of the sequence of words
            within = np.arange(len(words.doc)) - np.repeat(np.cumsum(count) - count, count)
            seat = mix(within.astype(np.uint64))
            whole = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
            for k, total in enumerate(whole):
                np.add.at(total, words.doc, mix((words.hashes + np.uint64(k)) ^ seat))
            own = batch.iloc[a:b]
            has = count > 0
            key1 = np.where(has, whole[0].view(np.int64), own["raw"].to_numpy())
            key2 = np.where(has, whole[1].view(np.int64), own["size"].to_numpy())
            low = (sig & np.uint64(0xFFFF)).astype(np.uint16)
            yield pd.DataFrame(
                {
                    "doc_id": own["doc_id"].to_numpy(),
                    "key1": key1,
                    "key2": key2,
                    "bands": [x if h else None for x, h in zip(bands.view(np.int64), has, strict=True)],
                    "sig": [x.tobytes() if h else None for x, h in zip(low, has, strict=True)],
                }
            )


def probability_jaccard(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Exactly, of two sorted sets of shingles with their weights."""
    union = np.union1d(one[0], two[0])
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, one[0])], y[np.searchsorted(union, two[0])] = one[1], two[1]
    shared = (x > 0) & (y > 0)
    if not shared.any():
        return 0.0
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    if x.max() <= 1 and y.max() <= 1:
        return float(shared.sum()) / len(union)
    order = np.argsort(ratio, kind="stable")
    r = ratio[order]
    above = np.append(np.cumsum(x[order][::-1])[::-1], 0.0)  # sum of x from here on
    below = np.concatenate(([0.0], np.cumsum(y[order])))  # sum of y before
    at = np.searchsorted(r, ratio[shared], "left")
    return float((1.0 / (above[at] / x[shared] + below[at] / y[shared])).sum())


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: OrderedDict[int, tuple] = OrderedDict()

    def parsed(node: int, text: str) -> tuple:
        if node not in known:
            known[node] = weighted_shingles([text], SHINGLE)[2:]
            while len(known) > 64:
                known.popitem(last=False)
        known.move_to_end(node)
        return known[node]

    for batch in batches:
        keep = []
        for a, b, s, t, x, y in batch[["a", "b", "sig_a", "sig_b", "text_a", "text_b"]].itertuples(index=False):
            agree = (np.frombuffer(s, np.uint16) == np.frombuffer(t, np.uint16)).mean()
            keep.append(agree >= LEAST_AGREEMENT and probability_jaccard(parsed(b, y), parsed(a, x)) >= SIMILARITY)
        yield batch.loc[np.array(keep, bool), ["a", "b"]]


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough."""
    for side in ("b", "a"):
        pairs = pairs.join(texts.toDF(side, f"sig_{side}", f"text_{side}"), side)
    return pairs.select("a", "b", "sig_a", "sig_b", "text_a", "text_b").mapInPandas(_verify, "a long, b long")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, class_id), one for each row of (doc_id, text): class_id is the smallest doc_id of its class.

    A class holds what chains of links of at least 0.8 connect. Texts with the same words in the same order are
    always of one class, and so are texts without any word that are the same. Null and empty texts are alike to
    nothing. All rows of a doc_id are one document. A row without doc_id has no class and takes no part.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    low = F.lower(F.coalesce("text", F.lit("")))
    raw = F.coalesce(F.xxhash64("text"), F.lit(0)).alias("raw")
    size = F.coalesce(-F.char_length("text") - 1, F.lit(-1)).cast("long").alias("size")
    known = rows.where("doc_id IS NOT NULL").select("doc_id", low.alias("text"), raw, size)
    signed = stored(
        known.mapInPandas(_sign, "doc_id long, key1 long, key2 long, bands array<long>, sig binary"), "signatures"
    )
    # copies: one node for each sequence of words
    alike = (F.col("bands").isNotNull()) | (F.col("key2") < -1)
    nodes = signed.where(alike).groupBy("key1", "key2").agg(F.min("doc_id").alias("node"))
    member = stored(
        signed.join(nodes, ["key1", "key2"], "left").select(
            "doc_id", F.coalesce("node", "doc_id").alias("node"),
            F.when(F.col("doc_id") == F.col("node"), F.col("bands")).alias("bands"),
            F.when(F.col("doc_id") == F.col("node"), F.col("sig")).alias("sig"),
        ),
        "members",
    )
    # buckets of two and more
    entry = member.where("bands IS NOT NULL").select("node", F.explode("bands").alias("bucket")).distinct()
    many = entry.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    entries = stored(entry.join(many, "bucket"), "buckets")
    degree = entries.groupBy("node").agg(F.sum("n").alias("degree"))
    bucket = stored(entries.select("bucket", "node").join(degree, "node"), "ranked")
    inside = degree.select(F.col("node").alias("doc_id"))
    text = known.select("doc_id", "text").join(inside, "doc_id", "left_semi").groupBy("doc_id").agg(F.first("text").alias("text"))
    sigs = member.where("sig IS NOT NULL").groupBy(F.col("node").alias("doc_id")).agg(F.first("sig").alias("sig"))
    texts = stored(text.join(sigs, "doc_id").select(F.col("doc_id").alias("node"), "sig", "text"), "texts")

    links = pairs_of_docs(member)
    label = None
    for _ in range(HUB_ROUNDS):
        named = bucket.withColumn("component", F.col("node")) if label is None else labelled(bucket, label)
        new = stored(_links(hub_pairs(named), texts), "links")
        links = links.union(new)
        if new.limit(1).count() or label is None:
            label = components(links)
    named = stored(labelled(bucket, label), "open")
    new = stored(open_links(named, long_signatures(named.select("node").distinct(), member, texts)), "links")
    if new.limit(1).count():
        label = components(links.union(new))
    ids = label.select(F.col("node"), F.col("component").alias("class_id"))
    classes = member.select("doc_id", "node").join(ids, "node", "left").select("doc_id", F.coalesce("class_id", "node").alias("class_id"))
    without = rows.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return classes.union(without)


def representatives(documents: DataFrame) -> DataFrame:
    """The rows, with all their columns, without those that are near-duplicates of one that stays.

    Each row is a document of its own, also if it shares its doc_id or has none. Of each class the row of the smallest
    doc_id stays, a null one being the largest; of rows that share it, one. Rows whose text is null or empty all stay.
    """
    key = "_row"
    while key in documents.columns:
        key += "_"
    rows = stored(documents.withColumn(key, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"))
    ids = rows.select(F.col(key).alias("row"), F.col("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))
    heads = found.join(ids, found["doc_id"] == ids["row"]).groupBy("class_id").agg(first.alias("head"))
    return rows.join(heads.select(F.col("head.row").alias(key)), key, "left_semi").drop(key)


def pairs_of_docs(member: DataFrame) -> DataFrame:
    """Links between the nodes of one doc_id, if its rows have different texts."""
    spread = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    return spread.where("a < b").select("a", "b")


def labelled(bucket: DataFrame, label: DataFrame) -> DataFrame:
    """Entries of the buckets that hold more than one component."""
    named = bucket.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return named.join(mixed.select("bucket"), "bucket", "left_semi")


def hub_pairs(named: DataFrame) -> DataFrame:
    """Each document with the best hub of its buckets, if they aren't connected: for n documents at most n pairs.

    A bucket has two hubs, the second one outside the component of the first.
    """
    best = F.max(F.struct("degree", (-F.col("node")).alias("minus"), "component"))
    top = named.groupBy("bucket").agg(best.alias("top"))
    rest = named.join(top, "bucket").where(F.col("component") != F.col("top.component"))
    second = rest.groupBy("bucket").agg(best.alias("second"))
    hubs = top.join(second, "bucket").select("bucket", F.explode(F.array("top", "second")).alias("hub"))
    apart = named.join(hubs, "bucket").where(F.col("component") != F.col("hub.component"))
    chosen = apart.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("hub.degree", "hub.minus")).alias("hub"))
    return chosen.select("a", (-F.col("hub.minus")).alias("b"))


def _lengthen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Long signatures: the last two bits of each place's shingle, four places in a byte."""
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in pieces(texts, 1 << 18):
            _, doc, shingle, weight = weighted_shingles(texts[a:b], SHINGLE)
            bits = (signatures(doc, shingle, weight, b - a, LONG_PLACES) & np.uint64(3)).astype(np.uint8)
            packed = bits[:, 0::4] | bits[:, 1::4] << 2 | bits[:, 2::4] << 4 | bits[:, 3::4] << 6
            own = batch.iloc[a:b]
            yield pd.DataFrame({"node": own["node"], "bands": own["bands"], "long": [x.tobytes() for x in packed], "text": own["text"]})


#: Of a byte that is the difference of two: how many of its four places agree.
_AGREE = np.array([sum(x >> 2 * k & 3 == 0 for k in range(4)) for x in range(256)], np.uint8)


#: Shingles that a task keeps parsed.
PARSED = 1 << 22


class _Parsed:
    """Shingles of the texts of a block, those used last."""

    def __init__(self, texts: list[str]) -> None:
        self.texts, self.known, self.size = texts, OrderedDict(), 0

    def __getitem__(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        if at not in self.known:
            self.known[at] = weighted_shingles([self.texts[at]], SHINGLE)[2:]
            self.size += len(self.known[at][0])
            while self.size > PARSED and len(self.known) > 2:
                self.size -= len(self.known.popitem(last=False)[1][0])
        self.known.move_to_end(at)
        return self.known[at]


def block_links(rows: pd.DataFrame) -> list[tuple[int, int]]:
    """Verified links (a, b) between entries of different components, of the blocks i and j of a bucket.

    A link is given only if those before it don't connect its ends, so there are fewer than entries. An entry's
    likeliest partners come first. A pair that shares several buckets is left to the first band that the two share.
    """
    node, of, block = rows["node"].to_numpy(), rows["component"].to_numpy().copy(), rows["block"].to_numpy()
    i, j, bucket = rows["i"].iat[0], rows["j"].iat[0], rows["bucket"].iat[0]
    bands = np.stack(rows["bands"].to_list())
    long = np.frombuffer(b"".join(rows["long"]), np.uint8).reshape(len(rows), -1)
    parsed, links = _Parsed(rows["text"].to_list()), []
    right = np.flatnonzero(block == j)
    for r in np.flatnonzero(block == i):
        with_ = right[(of[right] != of[r]) & ((node[right] > node[r]) | (i != j))]
        shared = bands[with_] == bands[r]
        with_ = with_[bands[r][shared.argmax(axis=1)] == bucket] if len(with_) else with_
        parts = [_AGREE[long[with_[at : at + 256]] ^ long[r]].sum(axis=1) for at in range(0, len(with_), 256)]
        share = (np.concatenate([np.zeros(0), *parts]) / LONG_PLACES - 0.25) / 0.75
        for c in with_[np.argsort(-share, kind="stable")[: (share >= LEAST_ESTIMATE).sum()]]:
            if of[c] == of[r]:
                continue
            x, y = parsed[r], parsed[c]
            # the similarity is at most the smaller weight of all against the larger
            small, large = sorted((x[1].sum(), y[1].sum()))
            if small >= SIMILARITY * large * (1 - 1e-9) and probability_jaccard(x, y) >= SIMILARITY:
                links.append((int(node[r]), int(node[c])))
                of[of == of[c]] = of[r]
    return links


def _link_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of every (bucket, i, j); rows come ordered by these."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        key = rows[["bucket", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        found = [x for a, b in zip(starts[:-1], starts[1:], strict=True) for x in block_links(rows.iloc[a:b])]
        rest = rows.iloc[starts[-1] :]
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])
    if rest is not None and len(rest):
        found = block_links(rest)
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])


def long_signatures(nodes: DataFrame, member: DataFrame, texts: DataFrame) -> DataFrame:
    bands = member.where("bands IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"))
    text = texts.join(nodes, "node", "left_semi").join(bands, "node").select("node", "bands", "text")
    return stored(text.mapInPandas(_lengthen, "node long, bands array<long>, long binary, text string"), "long")


def open_links(named: DataFrame, long: DataFrame, block: int = BLOCK) -> DataFrame:
    """The exact way for what no hub decided: entries of a bucket that are still of different components.

    A bucket is dealt in blocks, and each two of its blocks meet in one task, which verifies promising pairs.
    """
    size = named.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    entry = named.join(size, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")),
    )
    dealt = entry.select("bucket", "node", "component", "block", F.explode(pair).alias("pair")).select("*", "pair.*").drop("pair")
    ordered = dealt.join(long, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return ordered.mapInPandas(_link_blocks, "a long, b long").distinct()
