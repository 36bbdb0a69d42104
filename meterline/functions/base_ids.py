"""Label of a dispatching base, from a licence such as `B02884`."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (divisor, label) tried in this order, and the label when none divides.
DIVISOR_LABELS = ((7, "s"), (3, "a"))
OTHER_LABEL = "e"
HEX_WIDTH = 3
LARGEST = 2**63 - 1


def base_id(licence: Column) -> Column:
    """Label and zero-padded hex of the licence number; NULL unless all that follows the first letter is digits."""
    rest = F.substr(licence, F.lit(2))
    all_digits = (rest != "") & (F.translate(rest, "0123456789", "") == "")
    number = F.when(all_digits, rest.try_cast("long"))
    label = F.lit(OTHER_LABEL)
    for divisor, name in reversed(DIVISOR_LABELS):
        label = F.when(number % divisor == 0, name).otherwise(label)
    digits = F.lower(F.hex(number))
    padded = F.when(F.length(digits) < HEX_WIDTH, F.lpad(digits, HEX_WIDTH, "0")).otherwise(digits)
    return F.concat(label, F.lit("/"), padded)


def base_id_udf():
    """The same label as a vectorised UDF; slower than `base_id`, for callers that bring their own Python rule."""
    rules, other, width = DIVISOR_LABELS, OTHER_LABEL, HEX_WIDTH

    def label_of(licence: pd.Series) -> pd.Series:
        rest = licence.str.slice(1)
        digits = rest.str.fullmatch("[0-9]+").fillna(False).astype(bool)
        numbers = [int(x) for x in rest[digits]]
        labels = [next((name for divisor, name in rules if n % divisor == 0), other) for n in numbers]
        out = pd.Series([None] * len(licence), index=licence.index, dtype=object)
        out[digits] = [f"{x}/{n:0{width}x}" if n <= LARGEST else None for x, n in zip(labels, numbers, strict=True)]
        return out

    return F.pandas_udf(label_of, "string")
