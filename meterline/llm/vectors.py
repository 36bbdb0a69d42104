"""What the two vector searches share: which rows take part, and the last step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.common import stored


def usable(embeddings: DataFrame, value: Column | None = None) -> DataFrame:
    """Rows (vec_id, v) with v as array<double>, one for each vec_id, of the most common number of components.

    Rows with a null id or vector, or a null or non-finite component, are left out, and so are vectors without components
    and those of other lengths (of two equally common lengths the smaller counts), as they have no product with the rest.
    If rows share a vec_id, the smallest vector counts.
    """
    value = F.transform("embedding", lambda x: x.cast("double")) if value is None else value
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.exists(F.transform("embedding", lambda x: x.cast("double")), odd)
    rows = embeddings.where(fit).select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v"))
    one = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    size = one.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return one.where(F.size("v") == (size["size"] if size else 0))


def first_copies(vectors: DataFrame, k: int) -> DataFrame:
    """Of equal vectors those with the k + 1 smallest ids: no other can be among a query's k best."""
    same = W.partitionBy("v").orderBy("vec_id")
    return vectors.withColumn("turn", F.row_number().over(same)).where(F.col("turn") <= k + 1).drop("turn")


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query's finds the k best, ties to the smaller vec_id."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
