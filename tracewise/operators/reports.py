"""Coverage, backlog, history, duplicates and the digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.functions.hashing import AGENT
from tracewise.functions.text import printable
from tracewise.operators.settings import Settings, in_window
from tracewise.operators.turns import unjudged_answers

SHOWN, HEADLINE = 20, 160
#: States of the queue, in the order of the digest.
STATES = (
    "invalid_settings", "needs_human_review", "suppressed", "ai_error", "invalid_output", "deferred", "awaiting_inference",
    "insufficient_evidence", "missing_docs", "bad_docs", "stale_docs",
)


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))
    return out


def count_of(df: DataFrame, name: str, where: Column | str | None = None) -> DataFrame:
    df = df if where is None else df.where(where)
    return df.agg(F.count("*").alias(name))


def daily_activity(events: DataFrame, days: int = 30) -> DataFrame:
    """Traces and threads of each of the latest days with events."""
    return (
        events.groupBy(F.date_trunc("day", "event_time").alias("day")).agg(F.count_distinct("trace_id").alias("traces"), F.count_distinct("thread_id").alias("threads"))
        .orderBy(F.desc("day")).limit(days)
    )


def event_coverage(events: DataFrame) -> DataFrame:
    return events.groupBy(*AGENT).agg(
        F.count("*").alias("saved_events"), F.count_distinct("trace_id").alias("recorded_turns"), F.min("event_time").alias("earliest_event"), F.max("event_time").alias("latest_event")
    )


def turn_coverage(turns: DataFrame) -> DataFrame:
    return turns.groupBy(*AGENT).agg(
        F.count("*").alias("turns"), F.count_if("is_complete").alias("complete_turns"), F.count_if(~F.col("is_complete")).alias("incomplete_turns"),
        F.count_if(F.col("thread_id").isNull()).alias("turns_without_thread_id"), F.count_distinct("thread_id").alias("threads"),
        F.min("event_time_utc").alias("earliest_turn_utc"), F.max("event_time_utc").alias("latest_turn_utc"),
    )


def pair_coverage(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*AGENT).agg(
        F.count("*").alias("pairs"), F.count_distinct("pair_hash").alias("distinct_pair_identities"), F.count_distinct("thread_id").alias("threads_with_pairs"),
        F.count_distinct("response_trace_id").alias("answers_with_followup"), F.min("feedback_time_utc").alias("earliest_followup_utc"), F.max("feedback_time_utc").alias("latest_followup_utc"),
    )


def preflight(turns: DataFrame, settings: Settings | None) -> DataFrame:
    """One row even of an empty window: roots and what they lack, by the same rules as the turns, before anything is saved."""
    rows = in_window(turns, "event_time_utc", settings)
    no_question, no_thread = F.col("user_question").isNull(), F.col("thread_id").isNull()
    out = rows.agg(
        F.count("*").alias("root_turns"), F.count_if("is_complete").alias("complete_turns"), F.count_if(no_question).alias("without_question"),
        F.count_if(~F.col("is_complete") & ~no_question).alias("without_answer"), F.count_if(no_thread).alias("without_thread"),
        F.count_if(F.col("is_complete") & ~no_thread).alias("pairable_turns"), F.count_distinct("thread_id").alias("threads"), F.count_if(F.size("tool_evidence") > 0).alias("with_tools"),
    )
    verdict = F.lit("invalid_settings") if settings is None else F.when(F.col("root_turns") == 0, "no_turns").when(F.col("pairable_turns") < 2, "too_few").otherwise("ready")
    return out.withColumn("verdict", verdict)


def coverage_report(events: DataFrame, history: DataFrame, turns: DataFrame, pairs: DataFrame, config: DataFrame) -> DataFrame:
    return one_row(
        count_of(events, "captured_events"), count_of(history, "snapshots"),
        turns.agg(F.count("*").alias("turns"), F.count_if("is_complete").alias("complete_turns"), F.count_if(~F.col("is_complete")).alias("incomplete_turns")),
        count_of(pairs, "pairs"), count_of(unjudged_answers(turns, pairs, False), "complete_unpaired_turns"), count_of(config, "invalid_current_specs", "not specification_is_valid"),
    )


def backlog_report(pairs: DataFrame, config: DataFrame, candidates: DataFrame, settings: Settings | None, status: DataFrame) -> DataFrame:
    """Numbers are null, not zero, while settings are invalid."""
    cap = F.lit(settings.max_new_reviews if settings else 0).cast("long")
    known = config.select(*AGENT, "snapshot_id", "specification_is_valid")
    rows = in_window(pairs, "feedback_time_utc", settings, "thread_id").join(known, list(AGENT), "left")
    out = one_row(
        status.select("settings_status"),
        rows.agg(F.count("*").alias("pairs_in_selected_window"), F.count_if(F.col("snapshot_id").isNull()).alias("pairs_missing_snapshot"), F.count_if(F.coalesce(~F.col("specification_is_valid"), F.lit(False))).alias("pairs_invalid_snapshot")),
        candidates.agg(F.count("*").alias("unsaved_reviews_now")),
    )
    out = out.withColumn("unsaved_reviews_in_budget_now", F.least("unsaved_reviews_now", cap)).withColumn("deferred_reviews_now", F.col("unsaved_reviews_now") - F.col("unsaved_reviews_in_budget_now"))
    numbers = [c for c in out.columns if c != "settings_status"]
    return out if settings else out.withColumns({c: F.when(F.lit(False), F.col(c)) for c in numbers})


def finding_status_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("validation_status").agg(
        F.count("*").alias("reviews"), F.count_if(~F.col("contract_ok")).alias("failed_contract"), F.count_if(F.col("contract_ok") & ~F.col("quote_found")).alias("failed_quote_check"),
        F.min("reviewed_at").alias("first_reviewed_at"), F.max("reviewed_at").alias("last_reviewed_at"),
    )


def review_dashboard(pairs: DataFrame, candidates: DataFrame, inputs: DataFrame, reviews: DataFrame, config: DataFrame, settings: Settings | None) -> DataFrame:
    cap = F.lit(settings.max_new_reviews if settings else 0).cast("long")
    known = config.select(*AGENT, "specification_is_valid")
    return one_row(
        pairs.join(known, list(AGENT), "left").agg(
            F.count("*").alias("pairs_all_history"), F.count_if(F.col("specification_is_valid").isNull()).alias("pairs_missing_settings"),
            F.count_if(F.coalesce(~F.col("specification_is_valid"), F.lit(False))).alias("pairs_with_invalid_settings"),
        ),
        candidates.agg(F.count("*").alias("eligible_now"), F.greatest(F.count("*") - cap, F.lit(0).cast("long")).alias("deferred_now")),
        count_of(inputs, "prompts_saved"), count_of(reviews, "reviews_saved"), count_of(inputs.join(reviews, "review_id", "left_anti"), "prompts_awaiting_a_call"),
        count_of(config, "agents_with_invalid_settings", "not specification_is_valid"),
    )


def missing_results(review_inputs: DataFrame, reviews: DataFrame, advice_inputs: DataFrame, advice: DataFrame) -> DataFrame:
    a = count_of(review_inputs.join(reviews, "review_id", "left_anti"), "missing_results").select(F.lit("answer_review").alias("input_kind"), "missing_results")
    b = count_of(advice_inputs.join(advice, "recommendation_id", "left_anti"), "missing_results").select(F.lit("recommendation").alias("input_kind"), "missing_results")
    return a.union(b)


def duplicate_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Identities saved more than once, of any number of tables: name -> (table, key)."""
    out = None
    for name, (df, key) in tables.items():
        part = df.select(F.lit(name).alias("object_name"), F.col(key).cast("string").alias("identity"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("object_name", "identity").agg(F.count("*").alias("saved_rows")).where("saved_rows > 1")


def result_history(results: DataFrame, candidates: DataFrame) -> DataFrame:
    now_ = candidates.select("recommendation_id").distinct().withColumn("current", F.lit(True))
    return results.join(now_, "recommendation_id", "left").select(
        "recommendation_id", "generated_at", "surface", "review_status", F.when(F.col("current"), "current").otherwise("historical_not_current").alias("scope")
    )


def member_trace(members: DataFrame, inputs: DataFrame) -> DataFrame:
    """Members of groups (group_id, review_id, pair_hash, review_output_hash) back to the traces of their reviews."""
    return members.join(inputs.select("review_id", "response_trace_id", "feedback_trace_id", "thread_id"), "review_id")


def digest(queue: DataFrame) -> DataFrame:
    """One row: preview_status, a count for each state, and a text with at most SHOWN suggestions."""
    counts = queue.agg(F.count("group_id").alias("current_groups"), *(F.count_if(F.col("queue_status") == s).alias(s) for s in STATES))
    shown = queue.where("queue_status = 'needs_human_review'").select(
        "recommendation_id", F.when(F.col("recommendation_id").rlike("^[0-9a-fA-F]{64}$"), F.col("recommendation_id")).otherwise("[invalid id]").alias("id"),
        F.coalesce(printable(F.col("headline"), HEADLINE), F.lit("[headline omitted]")).alias("head"),
    ).distinct().orderBy(F.asc_nulls_last("recommendation_id"), "head").limit(SHOWN)
    lines = shown.agg(
        F.count("*").alias("displayed"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("recommendation_id").isNull().alias("n"), "recommendation_id", "head", "id"))), lambda s: F.concat(s.id, F.lit(": "), s.head)), "\n").alias("lines"),
    )
    rows = one_row(counts, lines)
    ok = F.col("invalid_settings") == 0
    rows = rows.withColumn("displayed", F.when(ok, F.col("displayed")).otherwise(0)).withColumn("lines", F.when(ok, F.col("lines")).otherwise(""))
    preview = F.when(~ok, "invalid_settings").when(F.col("current_groups") == 0, "empty_current_queue").otherwise("inspect_before_sending")
    said = F.concat_ws("\n", F.concat(F.lit("groups: "), F.col("current_groups").cast("string")), *(F.concat(F.lit(f"{s}: "), F.col(s).cast("string")) for s in STATES),
                       F.coalesce(F.nullif("lines", F.lit("")), F.lit("No suggestions.")))
    return rows.withColumn("preview_status", preview).withColumn("body", said).drop("lines")
