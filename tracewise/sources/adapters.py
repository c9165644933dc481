"""The given tables as model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.functions.hashing import AGENT
from tracewise.sources.spans import with_event_hash

BASE_NS = 1_704_067_200_000_000_000  #: 2024-01-01 UTC
CALENDAR = 90 * 24 * 60  #: minutes over which conversations start
TEXTS = ("span_id", "span_name", "span_type", "thread_id", "message_id", "user_question", "agent_answer", "tool_name", "executed_sql", "chart_definition", "status_code")


def _agent(number: Column) -> list[Column]:
    return [F.lit("DB").alias(AGENT[0]), F.lit("FEEDBACK").alias(AGENT[1]), F.concat(F.lit("agent"), number.cast("string")).alias(AGENT[2])]


def conversation_events(conversations: DataFrame) -> DataFrame:
    """A user row opens a trace; the assistant row after it is the trace's root; a system row is a span without a root.

    By fixed rules of conv_id and turn some threads are unknown, some answers redacted and some answers have tool spans.
    Conversations start a minute apart over CALENDAR minutes and then from the first day again, so that the same share
    of them lies in any window however many there are.
    """
    c, t = F.col("conv_id"), F.col("turn")
    is_answer = F.col("role") == "assistant"
    trace = F.concat(F.lit("c"), c.cast("string"), F.lit("-t"), F.when(is_answer, t - 1).otherwise(t).cast("string"))
    thread = F.when(c % 23 == 0, None).when(c % 17 == 0, "0").when(c % 19 == 0, "  ").otherwise(c.cast("string"))
    ns = F.lit(BASE_NS) + (c % CALENDAR * 60 + t) * 1_000_000_000 + 7
    answer = F.when((c * 7 + t) % 11 == 0, "[redacted]").otherwise(F.col("text"))

    def event(n: int, **columns: Column) -> Column:
        values = {"span_id": F.concat(F.lit("s"), t.cast("string"), F.lit(f"-{n}")), "status_code": F.lit("OK")} | columns
        return F.struct((ns + n).alias("event_epoch_ns"), *(values.get(x, F.lit(None)).cast("string").alias(x) for x in TEXTS))

    question = event(0, span_name=F.lit("planning"), span_type=F.lit("step"), thread_id=thread, user_question=F.col("text"))
    system = event(0, span_name=F.lit("SkillTool_load"), span_type=F.lit("step"), thread_id=thread)
    root = event(2, span_name=F.lit("agent"), span_type=F.lit("record_root"), thread_id=thread, message_id=F.concat(F.lit("m"), t.cast("string")), agent_answer=answer)
    tool = event(1, span_name=F.lit("query"), span_type=F.lit("tool"), tool_name=F.lit("run_sql"), executed_sql=F.concat(F.lit("select "), t.cast("string")))
    events = (
        F.when(F.col("role") == "user", F.array(question))
        .when(is_answer & (c % 5 == 0), F.array(tool, root))
        .when(is_answer, F.array(root)).otherwise(F.array(system))
    )
    rows = conversations.select(*_agent(c % 3), trace.alias("trace_id"), F.inline(events))
    return with_event_hash(rows)


def event_spans(events: DataFrame) -> DataFrame:
    """The events table as raw spans."""
    attributes = F.struct(
        F.when(F.col("event_type") == "purchase", "record_root").otherwise("step").alias("ai.observability.span_type"),
        F.col("user_id").cast("string").alias("agent.thread_id"),
        F.when(F.col("event_type") == "view", F.col("props")).alias("agent.planning.query"),
        F.when(F.col("event_type") == "purchase", F.col("value").cast("string")).alias("agent.response"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise("OK").alias("agent.status.code"),
    )
    trace = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMddHH"))
    return events.select(
        F.when(F.col("event_id") % 97 == 0, "LOG").otherwise("SPAN").alias("record_type"), "ts",
        F.to_json(F.struct(trace.alias("trace_id"), F.col("event_id").cast("string").alias("span_id"))).alias("trace"),
        F.to_json(F.struct(F.col("event_type").alias("name"))).alias("record"), F.to_json(attributes).alias("record_attributes"),
    )


def settings_history(events: DataFrame) -> DataFrame:
    """Each event as a snapshot of the settings of one of four agents; those of the fourth are no object."""
    n = F.col("user_id") % 4
    key = F.lit('"k": "')
    spec = F.when(n == 3, F.lit("[]")).otherwise(
        F.concat(F.lit('{"models": {"orchestration": "m1"}, "instructions": {"response": "Say '), F.col("event_type"),
                 F.lit('.", "orchestration": "Plan first."}, "props": '), F.col("props"), F.lit(', "list": [1, {}, []], '), key, F.col("event_type"), F.lit('"}'))
    )
    return events.select(
        F.format_string("%012d", "event_id").alias("snapshot_id"), F.col("ts").alias("captured_at"), *_agent(n), spec.alias("specification")
    )


def page_retrievals(pages: DataFrame) -> DataFrame:
    """Each page as the saved response of a search of one of the areas: usually one result, for some none, an error, a
    wrong shape, or a chunk that is no string."""
    from tracewise.operators.settings import AREAS

    p = F.col("page_id")
    area = F.element_at(F.array(*map(F.lit, AREAS)), (p % len(AREAS) + 1).cast("int"))
    title = F.coalesce(F.regexp_extract("html", r"<title>([^<]*)</title>", 1), F.lit(""))
    result = F.struct(F.col("url").alias("url"), title.alias("title"), F.coalesce("html", F.lit("")).alias("chunk"))
    ok = F.to_json(F.struct(F.array(result).alias("results")))
    response = (
        F.when(p % 13 == 0, F.lit('{"results": []}')).when(p % 17 == 0, F.lit('{"error": "timeout", "results": []}'))
        .when(p % 19 == 0, F.lit("[1]")).when(p % 23 == 0, F.lit('{"results": [{"url": "https://x", "title": "t", "chunk": 5}]}')).otherwise(ok)
    )
    return pages.select(
        F.format_string("r%08d", "page_id").alias("retrieval_id"),
        F.timestamp_add("MINUTE", p % 10_000, F.lit("2024-03-25 00:00:00").cast("timestamp_ntz")).alias("captured_at"),
        area.alias("area_key"), F.lit("search").alias("service_name"), F.concat(F.lit("about "), area).alias("query_text"), response.alias("response"),
    )
