"""Capture and activity as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewise.sources.spans import SPAN_SCHEMA, new_events, readable_events, with_event_hash

SETTLING = "15 minutes"
TRACE_ERROR = 0.01  #: standard deviation of a day's number of traces: of any number of days none is a tenth off; 13 KB a day
DAY = "event_day"  #: of the saved table's folders


def span_stream(spark: SparkSession, path: str, schema: str = SPAN_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def stream_capture(spans: DataFrame, table: str, agent: tuple[str, str, str], checkpoint: str) -> StreamingQuery:
    """Appends each micro-batch's new events to the Parquet table at a path, in a folder for each day of theirs. A replayed
    batch or an overlapping file adds nothing: the anti-join looks at all that is saved, not at a watermark's memory. An
    event's time is part of its identity, so only the batch's own days are read."""

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        events = with_event_hash(readable_events(batch, agent)).withColumn(DAY, F.to_date("event_time"))
        days = [r[0] for r in events.select(DAY).distinct().collect()]  # calendar days, however many events
        try:
            saved = spark.read.schema(events.schema).parquet(table).where(F.col(DAY).isin(days))
        except Exception as e:  # the first batch makes the table
            if "PATH_NOT_FOUND" not in str(e):
                raise
            saved = events.limit(0)
        new_events(events, saved).write.mode("append").partitionBy(DAY).parquet(table)

    return spans.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_activity(spans: DataFrame) -> DataFrame:
    """Spans and approximate traces of each day, settled after SETTLING."""
    at = spans.withColumn("at", F.col("ts").cast("timestamp"))
    trace = F.get_json_object("trace", "$.trace_id")
    return (
        at.withWatermark("at", SETTLING).groupBy(F.window("at", "1 day").alias("w"))
        .agg(F.count("*").alias("spans"), F.approx_count_distinct(trace, TRACE_ERROR).alias("traces")).select(F.col("w.start").alias("day"), "spans", "traces")
    )
