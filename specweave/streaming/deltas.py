"""The orphan report over streams of changes: signed counts per key, kept by the stream's state.

Rows that arrive in the tables' folders become signed deltas (``operators.references``); a streaming aggregation holds each
key's reference and existence counts, and every batch writes the counts of the keys it touched.  A reference whose target
comes later leaves the report, one whose last target is taken back enters it, one that is taken back itself leaves it.

Defined results: a batch that is repeated after a failure replaces its own counts; no file yet gives an empty report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from specweave.operators.references import current_orphans, deltas_of

_COUNTS = "target tinyint, key string, refs bigint, exists bigint, batch bigint"


def follow(spark: SparkSession, sources: dict[str, str], retracted: dict[str, str], schemas: dict[str, str], store: str, checkpoint: str) -> StreamingQuery:
    """Count the changes in the files that arrive, each file once: rows that come in the folders ``sources`` (table name ->
    folder), rows that are taken back in the folders ``retracted``."""
    folders = [(name, folder, sign) for sign, of in ((1, sources), (-1, retracted)) for name, folder in of.items()]
    streams = [deltas_of(spark.readStream.schema(schemas[name]).parquet(folder), name, sign=sign) for name, folder, sign in folders]
    counts = reduce(DataFrame.unionByName, streams).groupBy("target", "key").agg(F.sum("refs").alias("refs"), F.sum("exists").alias("exists"))

    def take(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{store}/{number:09d}")

    return counts.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def orphans_now(spark: SparkSession, store: str) -> DataFrame:
    """The orphan report after the last batch: of each key the counts of the last batch that touched it."""
    counts = spark.read.schema(_COUNTS).option("recursiveFileLookup", "true").parquet(store)
    last = counts.groupBy("target", "key").agg(F.max_by(F.struct("refs", "exists"), "batch").alias("c"))
    return current_orphans(last.select("target", "key", "c.refs", "c.exists"))
