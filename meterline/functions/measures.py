"""Sums and averages of fixed-point amounts held as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = 2.0**53


def unit_sum(amount: Column, scale: int) -> Column:
    """Sum of amounts in whole units of the last of `scale` decimals. Such sums can be added up further.

    An amount with further decimals fails the job.
    """
    unit = float(10**scale)
    units = F.rint(amount * unit)
    finer = F.raise_error(F.lit(f"an amount has more than {scale} decimals")).cast("double")
    return F.sum(F.when(F.abs(amount * unit - units) > 0.01, finer).otherwise(units))


def from_units(whole: Column, scale: int) -> Column:
    """A sum of units as an amount. One beyond 2**53 fails the job, as it may not be exact."""
    large = F.raise_error(F.lit("a sum is too large to be exact")).cast("double")
    return F.when(F.abs(whole) >= EXACT, large).otherwise(whole) / float(10**scale)


def fixed_sum(amount: Column, scale: int = 2) -> Column:
    """Sum of amounts with `scale` decimals, the same for every row order.

    Whole units of the last decimal are added: doubles hold those exactly up to 2**53, so
    partial sums from any number of tasks agree, and hash aggregation keeps a primitive buffer.
    An amount with further decimals, or a sum beyond that, fails the job.
    """
    return from_units(unit_sum(amount, scale), scale)


def fixed_avg(amount: Column, scale: int = 2) -> Column:
    return fixed_sum(amount, scale) / F.count(amount)
