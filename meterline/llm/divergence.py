"""How far the sources of a language differ in their words, exactly.

A group is a source within a language. A term's share in a group depends on the group and on how often the term occurs there,
its level, alone. So the difference of two groups needs only their joint table: how many terms have level a in one and b in
the other. With a 0/1 column for each (group, level) that occurs in a block of terms, one matrix product of the block with its
own transpose holds the joint tables of all pairs of groups; each is priced where it is made, and only prices leave the task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored

#: Shares are counted in billionths.
UNIT = 1_000_000_000

#: Added to each count.
PRIOR = 5

#: Distinct terms that a task counts before it hands on what it has.
HELD = 400_000

#: Terms in a block, on average.
BLOCK = 4096

#: Groups on a side of a tile of the product, and columns of one product, if not four for each group.
TILE, COLUMNS = 256, 256

#: What each byte of a text counts as: letters in lower case and all of UTF-8's upper half are part of a term.
_BYTES = bytes(b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs), a term more than once if a task has more terms than it may hold."""
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            terms, n = list(found), list(found.values())
            m = list(map(docs[lang, source].__getitem__, terms))
            for a in range(0, len(terms), 1 << 16):
                size = len(terms[a : a + (1 << 16)])
                columns = [[lang] * size, [source] * size, pa.array(terms[a : a + size], pa.binary()).cast(pa.string())]
                columns += [pa.array(x[a : a + size], pa.int64()) for x in (n, m)]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, pa.string()) for c in columns],
                    names=["lang", "source", "term", "n", "docs"],
                )
        counts.clear(), docs.clear()

    for batch in batches:
        held = 0
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source")), strict=True):
            terms = text.encode().translate(_BYTES).split()
            counts[lang, source].update(terms)
            docs[lang, source].update(set(terms))
            held += len(terms)
            if held > HELD:  # no more than so many can be new since the last look
                held = 0
                if sum(map(len, counts.values())) > HELD:
                    yield from hand_on()
        if sum(map(len, counts.values())) > HELD:
            yield from hand_on()
    yield from hand_on()


def term_counts(documents: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences of each term in a group, and documents of the group that hold it.

    Nulls count as empty. Counts leave a task added up, so a frequent term or a hot source is one row for each of its tasks.
    """
    rows = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    found = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    """Rows (lang, term, total, by_source): the terms in at least so many documents of a language, with their counts.

    by_source has one entry (source, n) for each source that holds the term.
    """
    by_term = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("by_source")
    )
    return by_term.where(F.col("docs") >= least).drop("docs")


def layouts(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, n_terms, sources): each language's kept terms and its groups (source, n), without terms too, by source.

    n is how often kept terms occur in the group.
    """
    groups = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    sums = kept.select("lang", F.inline("by_source")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    named = groups.join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
    by_lang = named.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    return by_lang.join(sizes, "lang", "left").select("lang", F.coalesce("n_terms", F.lit(0)).alias("n_terms"), "sources")


def shares(levels: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(UNIT * (level + PRIOR) / (total + PRIOR * n_terms)), exactly."""
    below = total + PRIOR * n_terms
    if below < 2**63 // UNIT - PRIOR:
        return 1 + UNIT * (levels + PRIOR) // below
    return np.array([1 + UNIT * (int(x) + PRIOR) // below for x in levels], np.int64)


def joint_prices(counts: np.ndarray, totals: list[int], n_terms: int, side: int) -> np.ndarray:
    """Sum over terms (rows) of the differences of share between each of the first `side` groups and each other one.

    counts holds the groups' counts (columns), the first `side` of them against the rest, or against themselves if there
    is no rest. Terms are taken in order of their totals, so that those of one product have few levels, as many at a
    time as give COLUMNS columns. Sums of fewer than 2^24 ones are exact in the product; prices are whole numbers.
    """
    width = counts.shape[1]
    out = np.zeros((side, width - side or side), np.int64)
    counts = counts[np.argsort(counts.sum(axis=1), kind="stable")]
    a, size = 0, 64
    while a < len(counts):
        size = min(2 * size, len(counts) - a)
        while True:
            part = counts[a : a + size]
            found = [np.unique(part[:, g], return_inverse=True) for g in range(width)]
            first = np.cumsum([0, *(len(levels) for levels, _ in found)])
            if size == 1 or first[-1] <= max(COLUMNS, 4 * width):
                break
            size = max(1, size // 2)
        onehot = np.zeros((size, first[-1]), np.float32)
        for g, (_, level) in enumerate(found):
            onehot[np.arange(size), first[g] + level] = 1
        price = np.concatenate([shares(levels, totals[g], n_terms) for g, (levels, _) in enumerate(found)])
        cut = first[side]
        left, right = (slice(0, cut), slice(cut, None)) if side < width else (slice(0, None), slice(0, None))
        joint = (onehot[:, left].T @ onehot[:, right]).astype(np.int64)
        joint *= np.abs(price[left, None] - price[None, right])
        bounds = first[side:-1] - cut if side < width else first[:-1]
        out += np.add.reduceat(np.add.reduceat(joint, first[:side], axis=0), bounds, axis=1)
        a += size
    return out


def _priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of terms, one for each pair of tiles, to rows (lang, source, item, value) with every pair of groups once."""
    sums: dict[tuple, np.ndarray] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, one, other), values in sums.items():
            i, j = np.triu_indices(len(one), 1) if one is other else map(np.ravel, np.indices(values.shape))
            names = np.array(one, object)[i], np.array(other, object)[j]
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(names[0]), pa.string()), "source": pa.array(names[0], pa.string()),
                 "item": pa.array(names[1], pa.string()), "value": values[i, j]}
            )
        sums.clear()

    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            lang, n_terms = row["lang"].as_py(), row["n_terms"].as_py()
            one, other, same = row["one"].values, row["other"].values, row["same"].as_py()
            groups = one if same else pa.concat_arrays([one, other])
            by_source = row["terms"].values
            entries = by_source.flatten()
            term = np.repeat(np.arange(len(by_source)), by_source.value_lengths().to_numpy())
            at = pc.index_in(entries.field("source"), value_set=groups.field("source"))
            here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            counts = np.zeros((len(by_source), len(groups)), np.int64)
            counts[term[here], at.drop_null().to_numpy()] = entries.field("n").to_numpy()[here]
            prices = joint_prices(counts, groups.field("n").to_pylist(), n_terms, len(one))
            names = tuple(one.field("source").to_pylist())
            key = (lang, names, names if same else tuple(other.field("source").to_pylist()))
            if key in sums:
                sums[key] += prices
            else:
                if len(sums) > 16:
                    yield from hand_on()
                sums[key] = prices
    yield from hand_on()


#: `shares` in SQL. Products of up to 31 digits, whole division.
_SHARE = "1 + cast({unit} as decimal(10, 0)) * cast({n} + {prior} as decimal(20, 0)) div cast({total} + {prior} * n_terms as decimal(20, 0))"


def _share(n: str, total: str) -> Column:
    return F.expr(_SHARE.format(unit=UNIT, prior=PRIOR, n=n, total=total))


def pair_differences(kept: DataFrame, layout: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) for every ordered pair of different sources of a language."""
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("n_terms") / BLOCK))
    sized = kept.join(layout.select("lang", "n_terms"), "lang").select("lang", "by_source", block.alias("block"))
    blocks = sized.groupBy("lang", "block").agg(F.collect_list("by_source").alias("terms"))
    tiles = F.expr(f"transform(sequence(0, (size(sources) - 1) div {TILE}), t -> slice(sources, t * {TILE} + 1, {TILE}))")
    sides = layout.select("lang", "n_terms", F.posexplode(tiles).alias("i", "one"), tiles.alias("tiles"))
    sides = sides.select("lang", "n_terms", "i", "one", F.posexplode("tiles").alias("j", "other")).where("i <= j")
    sides = sides.select("lang", "n_terms", "one", "other", (F.col("i") == F.col("j")).alias("same"))
    found = blocks.join(sides, "lang").mapInArrow(_priced, "lang string, source string, item string, value long")
    sums = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    names = layout.select("lang", F.explode("sources.source").alias("source"), F.col("sources.source").alias("others"))
    every = names.select("lang", "source", F.explode("others").alias("item")).where(F.col("source") < F.col("item"))
    once = every.join(sums, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    both = "array(struct(source, item), struct(item as source, source as item))"
    return once.select("lang", "value", F.expr(f"inline({both})")).select("lang", "source", "item", "value")


def over_represented(kept: DataFrame, layout: DataFrame, top: int) -> DataFrame:
    """Rows (lang, source, item, value, rank): each group's terms whose share exceeds that in the language, the first ones."""
    whole = F.expr("aggregate(sources, 0L, (sum, x) -> sum + x.n)").alias("lang_n")
    groups = layout.select("lang", "n_terms", whole, F.inline("sources")).withColumnRenamed("n", "group_n")
    held = kept.select("lang", F.col("term").alias("item"), "total", F.inline("by_source"))
    more = _share("n", "group_n") - _share("total", "lang_n")
    found = held.join(groups, ["lang", "source"]).select("lang", "source", "item", more.alias("value")).where("value > 0")
    return _ranked(found).where(F.col("rank") <= top)


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order))


def audit(documents: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Terms are runs of letters A-Z, lowered, and of characters beyond ASCII; each language keeps those in at least `least` of its
    documents. Part `pair` has the sum of share differences between a group and each other source of its language, part
    `term` the `top` kept terms that occur in the group and have a larger share there than in the whole language. Ranks
    start at 1, values descend, ties go by the item's bytes. All arithmetic is in whole numbers.

    Nulls in text, lang or source count as empty, an empty language or source being one like others. A group without kept
    terms, or without any text, is priced against the others of its language with counts of 0; in a language without kept
    terms all values are 0. A language's only source has no pairs. Repeated rows are documents of their own. An empty table
    gives no rows. Other columns are not read.
    """
    kept = stored(kept_terms(term_counts(documents), least), "kept-terms")
    layout = stored(layouts(documents, kept), "term-layouts")
    pairs = _ranked(pair_differences(kept, layout)).withColumn("part", F.lit("pair"))
    terms = over_represented(kept, layout, top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).union(terms.select(columns))
