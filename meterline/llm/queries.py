"""The registered queries of this package's operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    conversations, divergence, katz, language, mixing, neardup, packing, pii, quality, segment_search, sentence_pieces, tree_search, urls,
)
from meterline.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = remainder(F.col("doc_id"), 4) == 2
    model = language.fit(docs.where(~out))
    return language.predict(docs, model).withColumn("held_out", out)


#: Stands for a secret of the deployment: pseudonyms can be traced back by whoever has it.
PII_KEY = "example key"


@query
def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.filter(pii.found(F.col("text")), lambda m: pii.kind_of(m).isNotNull())
    return pii.pseudonymise(docs.withColumn("n_found", F.coalesce(F.size(found), F.lit(0))), PII_KEY)


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixed(docs).withColumn("probability", F.round("probability", 6))


URL_RULES = urls.rules(
    ["allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"]
)


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op8_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_search.nearest(table(spark, sf_dir, "embeddings"))


@query
def op10_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search.top_products(table(spark, sf_dir, "embeddings"))


ORACLES["op10_segment_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
"""


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


#: Where the public vocabulary lies on the driver; executors don't read it.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentence_pieces.load(VOCABULARY)
    return sentence_pieces.with_text(sentence_pieces.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)


@query
def op3_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remainder(F.col("doc_id"), 10) == 0
    model = katz.fit(docs.where(~out))
    scored = katz.score(docs.select(F.col("doc_id").alias("row"), "text"), model)
    held_out = remainder(F.col("row"), 10) == 0
    return scored.select(
        F.col("row").alias("doc_id"), held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


#: A public vocabulary without an end of text of its own that a text could not hold; 2 ends a document.
WORD_PIECES = "word_bpe_49k.json"


@query
def op12_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(WORD_PIECES), encoding="utf-8") as file:
        placed = packing.pack(table(spark, sf_dir, "documents"), file.read(), end_id=2)
    return placed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost"
    )


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce("text", ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT k, lang, source, unnest(list_transform(words, lambda x:
    translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term
  FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS docs FROM w GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS total FROM c GROUP BY ALL HAVING sum(docs) >= 30
), v AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS lang_n FROM kept GROUP BY lang
), g AS (
  SELECT lang, source, coalesce(sum(c.n) FILTER (kept.term IS NOT NULL), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN kept USING (lang, term)
  GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (g.n + 5 * v.v) AS p,
    1 + (1000000000 * (kept.total + 5)) // (v.lang_n + 5 * v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS r FROM both_parts
)
SELECT lang, source, part, item, f::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 50
"""


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) of `conversations` with the damage that a row's id and turn stand for."""
    space = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind, text = F.pmod(F.crc32(name), F.lit(20)), F.coalesce("text", space)
    return rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    found = conversations.summary(conversations.repair(damaged(given))).withColumnRenamed("conv_id", "found")
    every = given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
