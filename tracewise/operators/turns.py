"""Conversation turns and answer/follow-up pairs from saved events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.functions.hashing import AGENT, identity
from tracewise.functions.text import known_thread, usable
from tracewise.sources.scratch import materialise

CONTEXT = 6  #: positions before a follow-up that give context
BLOCK = 4096  #: positions of a thread in one window
COVERAGE = "follow-up as a proxy; no explicit rating; answers without a follow-up are not judged"
CONFIG_SCOPE = "as captured; the version that answered is unknown"
TOOL_PREFIXES = ("SkillTool_", "ChartTool-")  #: names of tool spans that have no tool field begin so
TOOL_FIELDS = ("event_hash", "span_id", "event_epoch_ns", "span_name", "tool_name", "executed_sql", "chart_definition", "status_code")
TURN_FIELDS = ("trace_id", "message_id", "event_epoch_ns", "user_question", "agent_answer", "status_code", "tool_evidence", "event_hashes")


def utc(t: Column) -> Column:
    """An instant as UTC wall time, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(t), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _ordered(items: Column, payload: str) -> Column:
    """Payloads of collected structs in their order, nulls left out."""
    return F.filter(F.transform(F.array_sort(items), lambda x: x[payload]), lambda x: x.isNotNull())


def conversation_turns(events: DataFrame, tool_prefixes: tuple[str, ...] = TOOL_PREFIXES) -> DataFrame:
    """One row for each agent and trace that has a root span.

    The latest root wins, and the earliest usable question; all of a trace's events are its evidence. One aggregation by
    agent and trace does all three. Turns are numbered within agent and thread before completeness is looked at; those
    without a thread are numbered like those of one thread. A thread may hold any share of all turns.
    """
    is_tool = (
        F.col("tool_name").isNotNull() | F.col("executed_sql").isNotNull() | F.col("chart_definition").isNotNull()
        | reduce(lambda c, p: c | F.coalesce(F.col("span_name").startswith(p), F.lit(False)), tool_prefixes, F.lit(False))
    )
    rows = events.withColumn("thread_id", known_thread(F.col("thread_id"))).withColumn("t", F.col("event_epoch_ns"))
    root = F.struct(
        "t", "span_id", "event_hash", "thread_id", "message_id", "event_time", "agent_answer", "status_code",
    )
    order = (F.col("t"), F.col("span_id").isNull().alias("no_span"), F.col("span_id"), F.col("event_hash"))
    per_trace = rows.groupBy(*AGENT, "trace_id").agg(
        F.max(F.when(F.col("span_type") == "record_root", root)).alias("root"),
        F.min(F.when(usable(F.col("user_question")), F.struct(*order, "user_question"))).alias("question"),
        F.collect_list(F.struct(*order, F.when(is_tool, F.struct(*TOOL_FIELDS)).alias("tool"))).alias("all"),
    )
    turns = per_trace.where("root is not null").select(
        *AGENT, F.col("root.thread_id").alias("thread_id"), "trace_id", F.col("root.message_id").alias("message_id"),
        F.col("root.event_time").alias("event_time"), F.col("root.t").alias("event_epoch_ns"), utc(F.col("root.event_time")).alias("event_time_utc"),
        F.col("root.event_hash").alias("root_event_hash"), F.col("question.user_question").alias("user_question"),
        F.col("root.agent_answer").alias("agent_answer"), F.col("root.status_code").alias("status_code"),
        _ordered(F.col("all"), "tool").alias("tool_evidence"), _ordered(F.col("all"), "event_hash").alias("event_hashes"),
        F.col("question.event_hash").alias("question_event_hash"),
        (F.col("question").isNotNull() & usable(F.col("root.agent_answer"))).alias("is_complete"),
    )
    hash_ = identity(*AGENT, "thread_id", "trace_id", "root_event_hash", "question_event_hash", "event_hashes")
    return numbered(turns, [*AGENT, "thread_id"], ["event_epoch_ns", "trace_id"], "turn_no").withColumn("turn_hash", hash_).drop("question_event_hash")


def numbered(rows: DataFrame, by: list[str], order: list[str], number: str) -> DataFrame:
    """rows with their number (from 1) by `order` within groups of any size; no two rows of a group may be equal by it.

    Rows are dealt out by ranges of group and order, so a large group lies in many ranges, and written once. A number is the
    place in the range's part of the group and the sizes of the group's parts before it; nulls in `by` are a group.
    """
    keys = [*by, *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = materialise(placed, "ranges").withColumn("range", F.shiftright("at", 33))
    parts = placed.groupBy("range", *by).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    so_far = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("before", F.sum("n").over(so_far) - F.col("n") - F.col("first") + 1)
    of = parts.select(F.col("range").alias("_range"), *(F.col(c).alias(f"_{c}") for c in by), "before")
    same = reduce(lambda c, k: c & F.col(k).eqNullSafe(F.col(f"_{k}")), by, F.col("range") == F.col("_range"))
    return placed.join(of, same).select(*rows.columns, (F.col("at") + F.col("before")).alias(number))


def answer_followup_pairs(turns: DataFrame) -> DataFrame:
    """An answer with the very next turn of its thread, both complete, and the complete ones of the six turns before it.

    Positions are gap-free, so the neighbour is a lag and the context a row frame; nothing is joined. A thread is cut into
    blocks of BLOCK positions, each of which gets the last CONTEXT turns of the block before as well, so a large thread is
    many windows.
    """
    block = F.expr(f"(turn_no - 1) div {BLOCK}")
    in_blocks = F.when((F.col("turn_no") - 1) % BLOCK >= BLOCK - CONTEXT, F.array(block, block + 1)).otherwise(F.array(block))
    w = Window.partitionBy(*AGENT, "thread_id", "block").orderBy("turn_no")
    me = F.struct(*TURN_FIELDS)
    whole = F.when(F.col("is_complete"), F.struct(me.alias("turn"), F.col("turn_hash"), F.col("event_hashes")))
    rows = turns.where("thread_id is not null").withColumn("block", F.explode(in_blocks)).withColumns({"me": me, "whole": whole})
    rows = rows.withColumns({"response": F.lag("whole").over(w), "prior": F.collect_list("whole").over(w.rowsBetween(-CONTEXT, -1))})
    rows = rows.where(F.col("block") == block)
    pairs = rows.where("is_complete and response is not null")
    evidence = F.struct(
        F.col("response.turn.trace_id").alias("response_trace_id"), F.col("trace_id").alias("feedback_trace_id"),
        F.transform("prior", lambda x: x.turn).alias("prior_turns"), F.col("me").alias("followup_turn"),
        F.lit(COVERAGE).alias("coverage"), F.lit(CONFIG_SCOPE).alias("config_scope"),
    )
    hash_ = identity(
        *AGENT, "thread_id", F.col("response.turn.trace_id"), F.col("trace_id"), F.col("response.turn_hash"), F.col("turn_hash"),
        F.transform("prior", lambda x: x.turn_hash), F.transform("prior", lambda x: x.event_hashes),
    )
    return pairs.select(
        *AGENT, "thread_id", F.col("response.turn.trace_id").alias("response_trace_id"), F.col("trace_id").alias("feedback_trace_id"),
        F.col("event_time").alias("feedback_time"), F.col("event_time_utc").alias("feedback_time_utc"), "turn_no",
        F.col("response.turn.user_question").alias("user_question"), F.col("response.turn.agent_answer").alias("agent_answer"),
        F.col("user_question").alias("followup_message"), evidence.alias("evidence"), hash_.alias("pair_hash"),
    )


def unjudged_answers(turns: DataFrame, pairs: DataFrame, threads_only: bool = True) -> DataFrame:
    """Complete turns that answer no pair; with threads_only, of known threads. Unjudged is not bad."""
    found = turns.where("is_complete")
    found = found.where("thread_id is not null") if threads_only else found
    return found.join(pairs.select(*AGENT, F.col("response_trace_id").alias("trace_id")), [*AGENT, "trace_id"], "left_anti")
