"""Mixing sources to target weights by iterative proportional fitting, in built-in functions only.

Tokens are counted by cell (source, language, topic). Raking multiplies cell weights until the shares of every source,
language and topic are the targets. Documents are then drawn with probabilities proportional to raked over counted
tokens, scaled so that the expected number of tokens is a stated fraction. The draw is a hash of the id: repeatable, and
independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored

MARGINS = ("source", "lang", "topic")
#: Shares of tokens to the power of this, made to sum to 1, are the targets: below 1 small groups gain.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 1.0}
ROUNDS = 20
FRACTION = 0.5
SEED = "mix"


def topic_of(text: Column) -> Column:
    """What kind of text it is: `empty`, `table`, `lines` (under 60 characters each) or `prose`."""
    text = F.coalesce(text, F.lit(""))
    lines = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1
    return (
        F.when(text == "", "empty")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.char_length(text) < 60 * lines, "lines")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """Words, counted by the spaces and line ends that separate them. None in a null or empty text."""
    apart = F.char_length(text) - F.char_length(F.replace(F.replace(text, F.lit(" ")), F.lit("\n")))
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(apart + 1).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to below 1 that depends on the id alone."""
    text = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(1 << 48)


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = 1e-9) -> DataFrame:
    """Cells (the margins, tokens) with `raked`, whose sums over each margin are its target shares.

    targets: for each margin a table (the margin, share). A margin's value that has no target gets no weight. Each round
    is written to the shared folder; only the largest factor comes to the driver, and the rounds end once it is 1.
    """
    state = stored(cells.withColumn("raked", F.col("tokens").cast("double")), "rake")
    for _ in range(rounds):
        for margin, target in targets.items():
            total = state.groupBy(margin).agg(F.sum("raked").alias("_total"))
            factor = total.join(target, margin, "left").select(
                margin, F.when(F.col("_total") > 0, F.coalesce("share", F.lit(0.0)) / F.col("_total")).otherwise(0.0).alias("_factor")
            )
            state = state.join(factor, margin).withColumn("raked", F.col("raked") * F.col("_factor")).drop("_factor")
        state = stored(state.select(*cells.columns, "raked"), "rake")
        # the last margin is met exactly; how far the first is off tells whether to go on
        margin, target = next(iter(targets.items()))
        off = state.groupBy(margin).agg(F.sum("raked").alias("_total")).join(target, margin)
        if (off.agg(F.max(F.abs(F.col("_total") - F.col("share")))).first()[0] or 0.0) < tolerance:
            break
    return state


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin: its shares of tokens to a power, made to sum to 1."""
    totals = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("_part"))
    whole = totals.agg(F.sum("_part").alias("_whole"))
    return totals.join(F.broadcast(whole)).select(margin, (F.col("_part") / F.col("_whole")).alias("share"))


def calibrated(cells: DataFrame, fraction: float, steps: int = 16, rounds: int = 14) -> float:
    """The scale c for which the tokens of min(1, c x raked / tokens) sum to the fraction of all.

    They grow with c, so an interval is narrowed to one of `steps` parts in each round, an aggregate of the cells that
    brings one row. Where cells of weight 0 hold too many tokens, all others are kept whole.
    """
    rates = stored(cells.where("tokens > 0").select("tokens", (F.col("raked") / F.col("tokens")).alias("rate")), "rates")
    total, some, least = rates.agg(
        F.sum("tokens"), F.sum(F.when(F.col("rate") > 0, F.col("tokens"))), F.min(F.when(F.col("rate") > 0, F.col("rate")))
    ).first()
    if not some:
        return 0.0
    goal, low, high = min(fraction * total, some), 0.0, 1.0 / least
    for _ in range(rounds):
        ends = [low + (high - low) * k / steps for k in range(1, steps + 1)]
        kept = rates.agg(*(F.sum(F.least(F.lit(1.0), F.col("rate") * c) * F.col("tokens")) for c in ends)).first()
        part = next((k for k in range(steps) if kept[k] >= goal), steps - 1)
        low, high = (ends[part - 1] if part else low), ends[part]
    return high


def mixed(
    documents: DataFrame,
    topic: Column | None = None,
    temper: dict[str, float] = TEMPER,
    targets: dict[str, DataFrame] | None = None,
    fraction: float = FRACTION,
    seed: str = SEED,
) -> DataFrame:
    """Rows (doc_id, source, lang, topic, tokens, probability, kept), one for each row of (doc_id, text, source, lang).

    Targets are given as tables (margin, share), or else the counted shares tempered. Null sources and languages are
    groups of their own, named `-`. Null and empty texts have no tokens and are never kept, nor is any row if there are
    no tokens at all. Rows of the same doc_id share a draw; those of a null doc_id draw as an empty id.
    """
    rows = stored(documents.select("doc_id", *described(topic).values()), "counted")
    chances = _chances(rows, temper, targets, fraction)
    known = rows.join(chances, list(MARGINS), "left")
    probability = F.when(F.col("tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    return known.select(
        "doc_id", *MARGINS, "tokens", probability.alias("probability"), (draw(F.col("doc_id"), seed) < probability).alias("kept")
    )


def described(topic: Column | None = None) -> dict[str, Column]:
    """The margins of a document and its tokens."""
    return {
        **{c: F.coalesce(F.col(c), F.lit("-")).alias(c) for c in ("source", "lang")},
        "topic": (topic_of(F.col("text")) if topic is None else topic).alias("topic"),
        "tokens": tokens_of(F.col("text")).alias("tokens"),
    }


def _chances(rows: DataFrame, temper: dict[str, float], targets: dict[str, DataFrame] | None, fraction: float) -> DataFrame:
    """Rows (the margins, probability), one for each cell that has tokens."""
    cells = stored(rows.where("tokens > 0").groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    wanted = targets or {m: stored(tempered(cells, m, temper[m]), "target") for m in MARGINS}
    raked = rake(cells, wanted)
    scale = calibrated(raked, fraction)
    chance = F.least(F.lit(1.0), F.col("raked") / F.col("tokens") * scale).alias("probability")
    return raked.select(*MARGINS, chance)


def sampled(
    documents: DataFrame,
    topic: Column | None = None,
    temper: dict[str, float] = TEMPER,
    targets: dict[str, DataFrame] | None = None,
    fraction: float = FRACTION,
    seed: str = SEED,
) -> DataFrame:
    """The rows that `mixed` keeps, with all their columns.

    Each row is judged where it is read: only the cells' chances are joined to it, no text is sent to find its row again.
    """
    of = described(topic)
    chances = stored(_chances(documents.select(*of.values()), temper, targets, fraction), "chances")
    cell = F.struct(*(of[m] for m in MARGINS))
    named = chances.select(F.struct(*MARGINS).alias("_cell"), F.col("probability").alias("_probability"))
    kept = (named["_cell"] == cell) & (of["tokens"] > 0) & (draw(F.col("doc_id"), seed) < named["_probability"])
    return documents.join(named, kept, "left_semi")
