"""Small static lookups kept as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.operators.checks import check_table, enforce
from meterline.sources.files import read_csv
from meterline.spec import Column, TableSpec

PAYMENT_LOOKUP = TableSpec(
    name="ingestion.payment_lookup",
    columns=(
        Column("payment_type_id", "int", "Code of the payment type", primary_key=True, checks=("not_null", "unique")),
        Column("payment_type_name", "string", "Name of the payment type", checks=("not_null",)),
    ),
)


def load_seed(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Read a seed with the declared types and fail if one of its checks does."""
    seed = read_csv(spark, path, spec.schema)
    enforce(check_table(spec, seed))
    return seed
