"""Span sources and insert-only capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.functions.hashing import AGENT, EVENT_FIELDS, identity
from tracewise.functions.text import trimmed
from tracewise.operators.settings import Settings, in_window

SPAN_SCHEMA = "record_type string, ts timestamp_ntz, trace string, record string, record_attributes string"
#: Column -> (JSON column, key). Keys may hold dots; a deployment passes its own.
FIELDS = {
    "trace_id": ("trace", "trace_id"), "span_id": ("trace", "span_id"), "span_name": ("record", "name"),
    "span_type": ("record_attributes", "ai.observability.span_type"), "thread_id": ("record_attributes", "agent.thread_id"),
    "message_id": ("record_attributes", "agent.message_id"), "user_question": ("record_attributes", "agent.planning.query"),
    "agent_answer": ("record_attributes", "agent.response"), "tool_name": ("record_attributes", "agent.planning.tool_execution.name"),
    "executed_sql": ("record_attributes", "agent.tool.sql_execution.final_sql"),
    "chart_definition": ("record_attributes", "agent.tool.chart_generation.input_chart_spec"),
    "status_code": ("record_attributes", "agent.status.code"),
}


def read_spans(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Spans with a declared schema; nothing is inferred."""
    return spark.read.schema(SPAN_SCHEMA).format(form).load(path)


SPAN_DAY = "span_day"  #: of the folders of spans saved by day


def write_daily(spans: DataFrame, path: str) -> None:
    """Appends raw spans to folders of their days (null for spans without a time). A day of any size is split over files of
    the session's advisory size; small days are one file of a run."""
    spans.withColumn(SPAN_DAY, F.to_date("ts")).hint("rebalance", SPAN_DAY).write.mode("append").partitionBy(SPAN_DAY).parquet(path)


def read_daily(spark: SparkSession, path: str, settings: Settings | None) -> DataFrame:
    """The spans of the window from folders of days: only folders of the window's days are opened, and within the first and
    the last of them the time decides. Without valid settings, none."""
    spans = spark.read.schema(f"{SPAN_SCHEMA}, {SPAN_DAY} date").parquet(path)
    if settings is not None:
        spans = spans.where(F.col(SPAN_DAY).between(settings.review_start.date(), settings.review_end.date()))
    return in_window(spans, "ts", settings).drop(SPAN_DAY)


def json_text(column: str, key: str) -> Column:
    """The text of a JSON object's key, as get_json_object has it. Most spans lack most keys, so a text is parsed only if the
    key stands in it; with a backslash always, as keys may be escaped."""
    may_hold = F.contains(column, F.lit(key)) | F.contains(column, F.lit("\\"))
    return F.when(may_hold, F.get_json_object(column, f"$['{key}']"))


def readable_events(spans: DataFrame, agent: tuple[str, str, str], fields: dict[str, tuple[str, str]] = FIELDS) -> DataFrame:
    """Spans with a trace as event columns. ts is UTC already; event_epoch_ns comes from it unless spans carry their own."""
    trace = json_text(*fields["trace_id"])
    ns = F.col("event_epoch_ns") if "event_epoch_ns" in spans.columns else F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) * 1000")
    rows = spans.where((F.col("record_type") == "SPAN") & (F.char_length(trimmed(trace)) > 0))
    return rows.select(
        *(F.lit(v).alias(n) for n, v in zip(AGENT, agent, strict=True)), ns.alias("event_epoch_ns"),
        *(json_text(*at).alias(name) for name, at in fields.items()),
    )


def with_event_hash(events: DataFrame) -> DataFrame:
    """Adds the instant of event_epoch_ns and the event's identity."""
    return events.withColumn("event_time", F.timestamp_micros(F.expr("event_epoch_ns div 1000"))).withColumn("event_hash", identity(*EVENT_FIELDS))


def new_events(batch: DataFrame, saved: DataFrame) -> DataFrame:
    """Events of the batch to append: one row for each identity, none that is saved already. Equal identities have equal
    columns, so any of them will do. Running it again after the append gives nothing."""
    on = ["event_hash", *AGENT]
    return batch.dropDuplicates(on).join(saved.select(*on), on, "left_anti")


def window_events(spans: DataFrame, agent: tuple[str, str, str], settings: Settings | None) -> DataFrame:
    """The events of a capture: the window as literals at the scan, columns and identities."""
    return with_event_hash(readable_events(in_window(spans, "ts", settings), agent))


def capture(spans: DataFrame, saved: DataFrame, agent: tuple[str, str, str], settings: Settings | None) -> DataFrame:
    """The whole capture step over a table of any layout: the window's events that are not among its rows."""
    return new_events(window_events(spans, agent, settings), saved)


def snapshot(specs: DataFrame) -> DataFrame:
    """Rows to append to the settings history from agent columns, captured_at and specification (JSON text). Ids are
    random: they name a capture, never a content."""
    return specs.select(F.uuid().alias("snapshot_id"), "captured_at", *AGENT, "specification")
