"""The batch operators on streams of files: duplicate-free ingest and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.session import checkpoint_folder


def read_files(spark: SparkSession, folder: str, pattern: str, schema, files_a_batch: int = 16) -> DataFrame:
    """A stream of the Parquet files of a folder that fit the pattern."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def unique_documents(docs: DataFrame, at: str, text: str, late: str = "7 days") -> DataFrame:
    """docs with input_hash, each text once within the watermark; works on streams and on batches."""
    hashed = docs.withColumn("input_hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    if docs.isStreaming:
        return hashed.withWatermark(at, late).dropDuplicatesWithinWatermark(["input_hash"])
    return hashed.dropDuplicates(["input_hash"])


def window_counts(events: DataFrame, at: str, by: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, by, n, least, greatest) of tumbling windows; rows later than the watermark are dropped from streams.

    Times without a zone are read as UTC, and start is a UTC time without zone, whatever the session's zone.
    """
    if dict(events.dtypes)[at] == "timestamp_ntz":
        events = events.withColumn(at, F.concat(F.col(at).cast("string"), F.lit("Z")).cast("timestamp"))
    src = events.withWatermark(at, late) if events.isStreaming else events
    return src.groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest")).select(
        F.convert_timezone(None, F.lit("UTC"), F.col("window.start")).alias("start"), by, "n", "least", "greatest"
    )


def run_to_end(stream: DataFrame, name: str) -> DataFrame:
    """All input that is there now, through the stream, as a table in the shared checkpoint folder.

    Complete output: every batch rewrites the aggregate, whose size is that of its groups.
    """
    spark = stream.sparkSession
    import uuid

    at = f"{checkpoint_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out")

    stream.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{at}/state").foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")
