"""Ratios of metrics, with the rule for an empty denominator named by the caller."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(part: str, whole: str = "view", zero: str = "as_one") -> Column:
    """`part / whole`.

    zero="as_one"  a zero whole counts as 1 (statistics)
    zero="as_zero" the rate is 0.0 unless the whole is positive; a missing part is 0 (warehouse)
    zero="null"    a zero whole gives null (features, and rows already filtered on whole > 0)
    """
    num, den = F.col(part).cast("double"), F.col(whole)
    if zero == "as_one":
        return num / F.when(den == 0, F.lit(1)).otherwise(den)
    if zero == "as_zero":
        safe = F.when(den > 0, den)
        return F.coalesce(F.coalesce(num, F.lit(0.0)) / safe, F.lit(0.0))
    if zero == "null":
        return num / F.when(den != 0, den)
    raise ValueError(f"unknown rule {zero!r}")


def total(*columns: str) -> Column:
    """Sum of columns of one row."""
    out = F.col(columns[0])
    for name in columns[1:]:
        out = out + F.col(name)
    return out


def mean(column: Column | str, digits: int | None = None) -> Column:
    """Mean of an integer column as one exact integer sum and one division.

    Unlike avg() it does not add doubles, so the result does not depend on the
    order in which partitions arrive.
    """
    col = F.col(column) if isinstance(column, str) else column
    out = F.sum(col).cast("double") / F.count(col)
    return out if digits is None else F.round(out, digits)
