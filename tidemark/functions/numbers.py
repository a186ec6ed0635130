"""Arithmetic, tiers and ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidemark.functions._columns import ColumnOrName, as_col

# Exclusive upper bound in dollars and its label, lowest first.
ASSET_TIERS = (
    (500_000_000, "Less than $500M"),
    (1_000_000_000, "$500M to $1B"),
    (5_000_000_000, "$1B to $5B"),
    (10_000_000_000, "$5B to $10B"),
    (50_000_000_000, "$10B to $50B"),
    (100_000_000_000, "$50B to $100B"),
    (500_000_000_000, "$100B to $500B"),
    (1_000_000_000_000, "$500B to $1T"),
    (3_000_000_000_000, "$1T to $3T"),
)
TOP_ASSET_TIER = "Greater than $3T"

# Inclusive upper bound of a growth ratio and its label.
GROWTH_TIERS = (
    (-0.05, ">5% decline"),
    (0.0, "0% to 5% decline"),
    (0.05, "0% to 5% growth"),
)
TOP_GROWTH_TIER = ">5% growth"

BYTES_PER_GIB = 1024 * 1024 * 1024


def unit_scale(value: ColumnOrName, factor: int = 1000) -> Column:
    """Thousands to units."""
    return as_col(value) * F.lit(factor)


def tier_below(
    value: ColumnOrName,
    bounds: Sequence[tuple[float, str]] = ASSET_TIERS,
    top: str = TOP_ASSET_TIER,
    null_tier: str | None = TOP_ASSET_TIER,
) -> Column:
    """Label of the first bound the value is below.

    NULL lands in ``null_tier``; the default is the top tier, which is what an
    unguarded CASE ladder with an ELSE does.
    """
    value = as_col(value)
    ladder = F.when(value.isNull(), F.lit(null_tier))
    for bound, label in bounds:
        ladder = ladder.when(value < F.lit(bound), F.lit(label))
    return ladder.otherwise(F.lit(top))


def growth_tier(
    ratio: ColumnOrName,
    bounds: Sequence[tuple[float, str]] = GROWTH_TIERS,
    top: str = TOP_GROWTH_TIER,
) -> Column:
    """Label of a growth ratio; NULL stays NULL. Bounds belong to the lower tier."""
    ratio = as_col(ratio)
    ladder = F.when(ratio.isNull(), F.lit(None).cast("string"))
    for bound, label in bounds:
        ladder = ladder.when(ratio <= F.lit(bound), F.lit(label))
    return ladder.otherwise(F.lit(top))


def ratio(numerator: ColumnOrName, denominator: ColumnOrName, safe: bool = False) -> Column:
    """``a / b`` as a double; a zero divisor is an error, or NULL when ``safe``."""
    top, bottom = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return F.try_divide(top, bottom) if safe else top / bottom


def guarded_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``a / b`` as a double, 0 where the divisor is 0, NULL where it is NULL."""
    bottom = as_col(denominator).cast("double")
    return F.when(bottom == 0, F.lit(0.0)).otherwise(as_col(numerator).cast("double") / bottom)


def bytes_to_gib(value: ColumnOrName) -> Column:
    return as_col(value).cast("double") / F.lit(float(BYTES_PER_GIB))
