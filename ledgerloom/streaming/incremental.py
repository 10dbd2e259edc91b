"""Incremental loads as Structured Streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.facts import optional_source
from ledgerloom.sources.load import new_only

PREFIX = "key_prefix"


def append_new_stream(
    source: DataFrame, target: str, schema: T.StructType, checkpoint: str, order: str, key: str = "checksum", prefix: int | None = None
) -> StreamingQuery:
    """Append the rows of a stream whose key the target does not have yet.

    Each micro-batch is checked against the table as it stands. A batch that
    is replayed after a failure finds its keys there and appends nothing, so
    the load is idempotent.

    With ``prefix`` the target is partitioned by that many first characters of
    the key (``key_prefix``), and a batch reads only the partitions its own
    keys fall into; for keys in hex their number is at most 16 ** prefix.
    """
    part = F.substring(key, 1, prefix) if prefix else None

    def load(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        if part is None:
            registered = optional_source(spark, target, schema)
            new_only(batch, registered, order, key).write.mode("append").parquet(target)
            return
        present = [r[0] for r in batch.select(part).distinct().collect()]
        stored = T.StructType([*schema.fields, T.StructField(PREFIX, T.StringType())])
        registered = optional_source(spark, target, stored, read_as=stored).where(F.col(PREFIX).isin(present))
        fresh = new_only(batch, registered, order, key).withColumn(PREFIX, part)
        fresh.write.mode("append").partitionBy(PREFIX).parquet(target)

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def file_stream(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """New files of a folder with their checksum, as a stream."""
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("modificationTime", T.TimestampType()),
            T.StructField("length", T.LongType()),
            T.StructField("content", T.BinaryType()),
        ]
    )
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("checksum"))
