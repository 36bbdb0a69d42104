from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_text(*parts: Column | str) -> Column:
    """Concatenate, reading NULL as empty text; plain strings are constants."""
    columns = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(*columns)
