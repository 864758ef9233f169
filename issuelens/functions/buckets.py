"""Binning of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound in minutes (inclusive) and label of each length group; fixed values.
DURATION_GROUPS = [
    (1, "0-1 min"),
    (3, "1-3 min"),
    (5, "3-5 min"),
    (10, "5-10 min"),
    (20, "10-20 min"),
    (60, "20-60 min"),
    (None, "60+ min"),
]


def duration_group(minutes: Column) -> Column:
    """Struct (duration_order, duration_group) of the first group whose bound holds the length."""
    last = len(DURATION_GROUPS)
    out = F.struct(
        F.lit(last).alias("duration_order"),
        F.lit(DURATION_GROUPS[-1][1]).alias("duration_group"),
    )
    for order in range(last - 1, 0, -1):
        bound, label = DURATION_GROUPS[order - 1]
        here = F.struct(F.lit(order).alias("duration_order"), F.lit(label).alias("duration_group"))
        out = F.when(minutes <= bound, here).otherwise(out)
    return out


def equal_width_bin(value: Column, low: Column, high: Column, bins: int, flat_width: float = 0.01) -> Column:
    """Index of the bin of `value`; the last bin is closed, a flat range uses `flat_width`."""
    spread = (high - low) / F.lit(float(bins))
    width = F.when(spread == 0, F.lit(flat_width)).otherwise(spread)
    return F.least(F.floor((value - low) / width).cast("int"), F.lit(bins - 1))
