"""Running values over very long groups, in two levels.

A window over a whole document would put all rows of a huge document into one task.  Here a group is cut into buckets of
its order column: the value is carried within each bucket, one row per bucket carries it across.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Positions per bucket.
BUCKET = 4096


def running_last(df: DataFrame, group: list[str], order: str, columns: dict[str, str], before: bool = False, bucket: int = BUCKET) -> DataFrame:
    """Adds for each ``columns`` item (new name -> column) the last non-null value up to each row (``before``: excluding it)."""
    cut = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(bucket)))
    inner = Window.partitionBy(*group, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    here = cut.withColumns({new: F.last(old, ignorenulls=True).over(inner) for new, old in columns.items()})
    ends = cut.groupBy(*group, "_bucket").agg(*[F.max_by(old, F.when(F.col(old).isNotNull(), F.col(order))).alias(f"_end_{new}") for new, old in columns.items()])
    outer = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*group, "_bucket", *[F.last(f"_end_{new}", ignorenulls=True).over(outer).alias(f"_carried_{new}") for new in columns])
    joined = here.join(carried, [*group, "_bucket"], "left")
    return joined.withColumns({new: F.coalesce(new, f"_carried_{new}") for new in columns}).drop("_bucket", *[f"_carried_{new}" for new in columns])


def running_sum(df: DataFrame, group: list[str], order: str, column: str, new: str, bucket: int = BUCKET) -> DataFrame:
    """Adds the sum of ``column`` up to and including each row."""
    cut = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(bucket)))
    inner = Window.partitionBy(*group, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    here = cut.withColumn(new, F.sum(column).over(inner))
    ends = cut.groupBy(*group, "_bucket").agg(F.sum(column).alias("_net"))
    outer = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*group, "_bucket", F.sum("_net").over(outer).alias("_carried"))
    return here.join(carried, [*group, "_bucket"], "left").withColumn(new, F.col(new) + F.coalesce("_carried", F.lit(0))).drop("_bucket", "_carried")
