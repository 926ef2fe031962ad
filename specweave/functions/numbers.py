"""Number kernels: compensated sums and half-even rounding, so that thresholds fall as in IEEE arithmetic with care."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def precise_sum(terms: list[Column]) -> Column:
    """Sum of doubles with a running compensation of the rounding errors (Neumaier), in the given order."""
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))

    def step(a: Column, v: Column) -> Column:
        t = a["s"] + v
        lost = F.when(F.abs(a["s"]) >= F.abs(v), (a["s"] - t) + v).otherwise((v - t) + a["s"])
        return F.struct(t.alias("s"), (a["c"] + lost).alias("c"))

    return F.aggregate(F.array(*[t.cast("double") for t in terms]), start, step, lambda a: a["s"] + a["c"])


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))
