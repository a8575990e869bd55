"""Execution logs: counts and times by status and pipeline, sample statistics, batches, degradations, retries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_events(events: DataFrame) -> DataFrame:
    """Event rows as log rows: (log_id, at, pipeline, status, seconds, confidence)."""
    status = (
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "click", "WARNING").when(F.col("event_type") == "signup", "REQUIRES_REVIEW").otherwise("SUCCESS")
    )
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return events.select(F.col("event_id").alias("log_id"), F.col("ts").alias("at"), F.when(F.col("user_id") % 2 == 0, "procurement").otherwise("specification").alias("pipeline"), status.alias("status"), F.col("value").alias("seconds"), k.alias("confidence"))


def execution_report(logs: DataFrame) -> DataFrame:
    kind = lambda s: F.count_if(F.col("status") == s)
    n = F.count(F.lit(1))
    return logs.agg(
        n.alias("total_documents"), kind("SUCCESS").alias("successful"), kind("WARNING").alias("warnings"), kind("FAILED").alias("failed"),
        (F.try_divide(kind("SUCCESS"), n) * 100).alias("success_rate"), F.avg("confidence").alias("average_confidence"),
    )


def by_pipeline(logs: DataFrame) -> DataFrame:
    return logs.groupBy("pipeline", "status").agg(F.count(F.lit(1)).alias("n"), F.min("confidence").alias("least_confidence"), F.max("confidence").alias("greatest_confidence"))


def sample_statistics(logs: DataFrame, by: str, value: str) -> DataFrame:
    """(by, average, least, greatest, deviation): the sample deviation of one value is 0."""
    return logs.groupBy(by).agg(F.avg(value).alias("average"), F.min(value).alias("least"), F.max(value).alias("greatest"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("deviation"))


def degradations(df: DataFrame, document: str, method: str, error: str) -> DataFrame:
    """One row: records with an error or an emergency method, their documents and the distinct methods, sorted."""
    bad = df.where((F.coalesce(F.col(error), F.lit("")) != "") | F.col(method).isin("ocr_unavailable", "ocr_error", "error"))
    return bad.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(document).alias("documents"), F.concat_ws(",", F.array_sort(F.collect_set(method))).alias("methods"))


def with_fallback(df: DataFrame, primary, fallback, out: str) -> DataFrame:
    """df with out, attempts and method: the primary expression where it gives a value, else the fallback."""
    return df.withColumns(
        {
            out: F.coalesce(primary, fallback),
            "attempts": F.when(primary.isNotNull(), 1).otherwise(2),
            "method": F.when(primary.isNotNull(), "primary").when(fallback.isNotNull(), "fallback").otherwise("none"),
        }
    )
