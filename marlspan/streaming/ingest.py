"""Ingest of files as they arrive: every run takes what is new and stops; what was done is in the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marlspan.operators.rows import numbered


def new_files(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "json", per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(kind).load(folder)


def available_now(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run all that is there through batch(rows, number), once each, and stop."""
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def into_dense_ids(folder: str, *order: Column) -> Callable[[DataFrame, int], None]:
    """A batch writer that goes on with the ids of what is there. A batch that runs again replaces itself."""

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        before = 0
        if fs.exists(path):
            done = spark.read.parquet(folder).where(F.col("batch") < number)
            before = (done.agg(F.max("idx")).first()[0] if "idx" in done.columns else None)
            before = 0 if before is None else before + 1
        out = numbered(rows, *order).withColumn("idx", F.col("pos") + before).drop("pos")
        out.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return batch


def event_totals(stream: DataFrame, minutes: int = 60, late: str = "1 hour") -> DataFrame:
    """Events and their value by type and window of event time; later events than the watermark are left out."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
