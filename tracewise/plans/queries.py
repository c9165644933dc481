"""Registered queries. Times are whole microseconds of UTC, so that either engine prints the same."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.functions.hashing import AGENT, leaf_digests, members_digest, root_digests, updated_leaves
from tracewise.functions.variants import flattened, with_canonical_hash
from tracewise.operators import config, docs, findings, recommend, reports, search, settings, turns, work, workflow
from tracewise.plans.model import AS_OF, SERVICE, Model
from tracewise.sources import adapters, runlog, saved, spans
from tracewise.sources.scratch import materialise, new_path
from tracewise.streaming import capture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NAMES = (*AGENT,)


def query(f: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Model(spark, sf_dir))
    return f


def us(c: str | Column, name: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz")).cast("long").alias(name)


def ns_us(c: str, name: str) -> Column:
    return F.expr(f"{c} div 1000").alias(name)


@query
def conversation_turns(m: Model) -> DataFrame:
    return m.turns.select(*NAMES, "thread_id", "trace_id", "message_id", "event_epoch_ns", "root_event_hash", "user_question", "agent_answer", "status_code", "is_complete", "turn_no",
                          F.size("tool_evidence").cast("long").alias("tool_spans"), F.size("event_hashes").cast("long").alias("event_count"), "turn_hash")


@query
def answer_followup_pairs(m: Model) -> DataFrame:
    return m.pairs.select(*NAMES, "thread_id", "response_trace_id", "feedback_trace_id", us("feedback_time_utc", "feedback_us"), "turn_no", "user_question", "agent_answer", "followup_message",
                          F.size("evidence.prior_turns").cast("long").alias("context_turns"), F.element_at("evidence.prior_turns", 1).trace_id.alias("first_context"), "pair_hash")


@query
def pair_context_tools(m: Model) -> DataFrame:
    """Tool spans in the context of each pair."""
    tools = F.flatten(F.transform("evidence.prior_turns", lambda t: F.coalesce(t.tool_evidence, F.array())))
    rows = m.pairs.select("pair_hash", F.posexplode(tools).alias("pos", "tool"))
    return rows.select("pair_hash", F.col("pos").cast("long").alias("pos"), "tool.event_hash", "tool.span_name", "tool.executed_sql")


@query
def pair_coverage(m: Model) -> DataFrame:
    return reports.pair_coverage(m.pairs).select("*", us("earliest_followup_utc", "earliest_us"), us("latest_followup_utc", "latest_us")).drop("earliest_followup_utc", "latest_followup_utc")


@query
def turn_coverage(m: Model) -> DataFrame:
    return reports.turn_coverage(m.turns).select("*", us("earliest_turn_utc", "earliest_us"), us("latest_turn_utc", "latest_us")).drop("earliest_turn_utc", "latest_turn_utc")


@query
def event_coverage(m: Model) -> DataFrame:
    return reports.event_coverage(m.events).select(*NAMES, "saved_events", "recorded_turns", F.unix_micros("earliest_event").alias("earliest_us"), F.unix_micros("latest_event").alias("latest_us"))


@query
def event_hash(m: Model) -> DataFrame:
    return m.events.select("event_hash", "trace_id", "span_id", "span_type", "thread_id", "event_epoch_ns")


@query
def turn_hash(m: Model) -> DataFrame:
    return m.turns.select("turn_hash", "trace_id", F.explode("event_hashes").alias("event_hash"))


@query
def pair_hash(m: Model) -> DataFrame:
    return members_digest(m.pairs, [*NAMES], "pair_hash").select(*NAMES, F.col("digest").alias("all_pairs"), F.col("n").alias("pairs"))


@query
def pair_hash_appended(m: Model) -> DataFrame:
    """The same identity from the leaves of most pairs, to which the others are appended; and how many leaves stayed."""
    names = [*NAMES]
    pairs = materialise(m.pairs.select(*names, "pair_hash"), "pair-hashes")
    saved, new = pairs.where("substr(pair_hash, 1, 1) <> '7'"), pairs.where("substr(pair_hash, 1, 1) = '7'")
    leaves = materialise(leaf_digests(saved, names, "pair_hash"), "leaves")
    after = materialise(updated_leaves(leaves, saved, new, names, "pair_hash"), "leaves")
    same = leaves.join(after, [*names, "leaf", "n", "digest"]).groupBy(*names).agg(F.count("*").alias("leaves_kept"))
    return root_digests(after, names).join(same, names).select(*names, F.col("digest").alias("all_pairs"), F.col("n").alias("pairs"), "leaves_kept")


@query
def activity_profile(m: Model) -> DataFrame:
    e = spans.readable_events(adapters.event_spans(m.table("events")), ("DB", "FEEDBACK", "web"))
    return reports.daily_activity(spans.with_event_hash(e)).select(F.unix_micros("day").alias("day_us"), "traces", "threads")


@query
def preflight_counts(m: Model) -> DataFrame:
    return reports.preflight(m.turns, m.settings)


@query
def unjudged_answers(m: Model) -> DataFrame:
    return turns.unjudged_answers(m.turns, m.pairs).select("thread_id", "turn_no", "trace_id", "user_question")


@query
def readable_spans(m: Model) -> DataFrame:
    e = spans.with_event_hash(spans.readable_events(adapters.event_spans(m.table("events")), ("DB", "FEEDBACK", "web")))
    return e.select("event_hash", "trace_id", "span_id", "span_name", "span_type", "thread_id", "user_question", "agent_answer", "status_code", "event_epoch_ns")


def _captured(m: Model, rows: DataFrame) -> DataFrame:
    return spans.window_events(rows, ("DB", "FEEDBACK", "web"), m.settings)


def _saved_events(m: Model, like: DataFrame) -> saved.SavedTable:
    """An empty saved table of events, with buckets for all of the events table."""
    return saved.SavedTable(m.spark, new_path(m.spark, "saved"), like.schema, "event_hash", buckets=saved.buckets_for(m.table("events").count()))


@query
def capture_insert_only(m: Model) -> DataFrame:
    """An overlapping second capture adds what the first lacked: the first took ids that 3 does not divide."""
    raw = adapters.event_spans(m.table("events"))
    first = _captured(m, adapters.event_spans(m.table("events").where("event_id % 3 <> 0")))
    table = _saved_events(m, first)
    table.merge(first)
    return table.merge(_captured(m, raw.unionByName(raw))).select("event_hash", "span_id", "span_name", "event_epoch_ns")


@query
def capture_rerun_is_empty(m: Model) -> DataFrame:
    raw = adapters.event_spans(m.table("events"))
    events = spans.with_event_hash(spans.readable_events(raw, ("DB", "FEEDBACK", "web")))
    table = _saved_events(m, events)
    table.merge(events)
    return reports.count_of(table.merge(_captured(m, raw)), "new_events")


@query
def captured_in_parts(m: Model) -> DataFrame:
    """Four captures of overlapping parts of the events: what each of them added, and the whole table after them."""
    events = m.table("events")
    table, added = None, []
    for i, part in enumerate(("event_id % 4 = 0", "event_id % 4 <= 1", "event_id % 2 = 0", "true")):
        rows = spans.with_event_hash(spans.readable_events(adapters.event_spans(events.where(part)), ("DB", "FEEDBACK", "web")))
        table = table or _saved_events(m, rows)
        added.append(table.merge(rows).groupBy("span_name").agg(F.count("*").alias("events")).select(F.lit(f"run {i}").alias("of"), "*"))
    return _union([*added, table.rows().groupBy("span_name").agg(F.count_distinct("event_hash").alias("events")).select(F.lit("table").alias("of"), "*")])


def _made_settings(m: Model) -> DataFrame:
    """Settings made of each order."""
    o = m.table("orders")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    return o.select(
        (F.col("o_orderkey") % 7).cast("int").alias("settings_id"), start.alias("review_start"), F.timestamp_add("DAY", F.col("o_custkey") % 120 - 5, start).alias("review_end"),
        F.when(F.col("o_custkey") % 5 == 0, " 0 ").when(F.col("o_custkey") % 5 == 1, "\t").when(F.col("o_custkey") % 5 == 2, " t1 ").alias("thread_filter"),
        (F.col("o_custkey") % 110).cast("int").alias("max_new_reviews"), (F.col("o_orderkey") % 25).cast("int").alias("max_new_recommendations"),
        (F.col("o_custkey") % 1100).cast("int").alias("min_occurrences"), (F.col("o_orderkey") % 800).cast("int").alias("docs_max_age_hours"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("prompt_revision"),
    )


@query
def settings_checks(m: Model) -> DataFrame:
    """The row checks over settings made of each order."""
    checked = settings.checked_settings(_made_settings(m), AS_OF)
    names = [*settings.checks(AS_OF), "row_is_valid"]
    return checked.agg(F.count("*").alias("settings_rows"), *(F.count_if(c).alias(c) for c in names))


@query
def current_config(m: Model) -> DataFrame:
    return m.config.select(*NAMES, "snapshot_id", us("captured_at", "captured_us"), "specification_is_valid", "config_hash")


@query
def config_instructions(m: Model) -> DataFrame:
    return config.instructions(m.config)


@query
def config_hash(m: Model) -> DataFrame:
    """Identities of all snapshots of the history, key order no matter."""
    counts = m.history.where("specification <> '[]'").groupBy("specification").agg(F.count("*").alias("snapshots"))
    return with_canonical_hash(counts, "specification", "config_hash").groupBy("config_hash").agg(F.sum("snapshots").alias("snapshots"))


@query
def config_nodes(m: Model) -> DataFrame:
    """Every node of the distinct specifications, apart from their numbers, counted by path, type and value."""
    texts = m.history.select("specification", F.sha2("specification", 256).alias("text")).distinct()
    nodes = flattened(texts, "text", "specification").where("type <> 'NUMBER'")
    return nodes.groupBy("path", "type", "value").agg(F.count("*").alias("nodes"))


@query
def review_candidates(m: Model) -> DataFrame:
    return m.candidates.select("review_id", "pair_hash", "config_hash", "thread_id", us("feedback_time_utc", "feedback_us"), "model_name", "prompt_revision", "schema_revision")


@query
def review_budget(m: Model) -> DataFrame:
    cap = m.settings.max_new_reviews
    rows = work.batch(m.candidates.select("feedback_time_utc", "review_id"), ["feedback_time_utc", "review_id"], cap, "review_rank")
    return rows.select("review_id", F.col("review_rank").cast("long").alias("review_rank"))


@query
def review_ranks(m: Model) -> DataFrame:
    """The place of every candidate in the queue, with valid settings and without."""
    rows = m.candidates.select("feedback_time_utc", "review_id", "thread_id")
    return _union([findings.ranked_candidates(rows, s).select(F.lit(k).alias("case"), "review_id", "thread_id", "review_rank", "is_within_budget") for k, s in (("valid", m.settings), ("invalid", None))])


@query
def review_queue_counts(m: Model) -> DataFrame:
    return findings.queue_counts(m.candidates, m.settings).select("eligible_reviews", "reviews_this_run", "deferred_reviews", "threads", us("earliest_followup_utc", "earliest_us"), us("latest_followup_utc", "latest_us"))


@query
def review_inputs_append(m: Model) -> DataFrame:
    """Saved inputs after the other candidates are appended; counts by whether a reply is saved."""
    cols = ["review_id", "pair_hash"]
    all_ = work.append_new(m.all_candidates.select(cols), m.review_inputs.select(cols), "review_id")
    done = m.reviews.select("review_id").withColumn("has_reply", F.lit(True))
    return all_.join(done, "review_id", "left").groupBy(F.coalesce("has_reply", F.lit(False)).alias("has_reply")).agg(F.count("*").alias("inputs"))


@query
def review_findings(m: Model) -> DataFrame:
    return m.findings.select("review_id", "validation_status", "validation_note", *findings.FIELDS, "contract_ok", "quote_found", us("reviewed_at", "reviewed_us"))


@query
def finding_status_counts(m: Model) -> DataFrame:
    return reports.finding_status_counts(m.findings).select("validation_status", "reviews", "failed_contract", "failed_quote_check", us("first_reviewed_at", "first_us"), us("last_reviewed_at", "last_us"))


@query
def latest_findings(m: Model) -> DataFrame:
    """The twenty newest valid findings."""
    rows = m.findings.where("validation_status = 'valid'").orderBy(F.desc("feedback_time_utc"), "review_id").limit(20)
    return rows.select("review_id", "assessment", "surface", us("feedback_time_utc", "feedback_us"))


@query
def review_dashboard(m: Model) -> DataFrame:
    return reports.review_dashboard(m.pairs, m.candidates, m.review_inputs, m.reviews, m.config, m.settings)


@query
def doc_passages(m: Model) -> DataFrame:
    return m.passages.select("retrieval_id", "area_key", F.col("passage_index").cast("long").alias("passage_index"), "url", "title", "passage_id")


@query
def doc_status(m: Model) -> DataFrame:
    return m.doc_status.select("retrieval_id", "area_key", "malformed_envelope", "has_error", "result_count", "accepted_count", "rejected_count", "documentation_status")


@query
def doc_latest(m: Model) -> DataFrame:
    return m.doc_latest.select("area_key", "query_text", "retrieval_id", us("captured_at", "captured_us"), "documentation_status", "content_hash")


@query
def doc_readiness(m: Model) -> DataFrame:
    return docs.doc_readiness(m.areas, m.doc_latest, m.settings, SERVICE, AS_OF).select("area_key", "documentation_query", "retrieval_id", "accepted_count", "rejected_count", "content_hash", "input_status")


@query
def doc_alignment(m: Model) -> DataFrame:
    return docs.doc_alignment(m.areas, m.doc_latest, SERVICE)


@query
def search_topk(m: Model) -> DataFrame:
    """The best five documents for each benchmark text."""
    queries = m.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    return search.search_passages(queries, m.table("documents"))


@query
def observations(m: Model) -> DataFrame:
    return m.observations.select("review_id", "pair_hash", "config_hash", "assessment", "issue_type", "severity", "surface", "thread_id", "review_output_hash")


_LATE = '{"value":null,"error":"late"}'


def _again(replies: DataFrame, key: str, stamp: str) -> DataFrame:
    """Replies with second ones to the same keys, all of them errors: older ones to all, newer ones to some."""
    other = lambda days: replies.withColumns({stamp: F.timestamp_add("DAY", F.lit(days), F.col(stamp)), "model_response": F.lit(_LATE)})
    return _union([replies, other(-1), other(1).where(F.substr(key, F.lit(5), F.lit(1)) == "8")])


@query
def observations_of_several_replies(m: Model) -> DataFrame:
    """Observations where each review was sent twice: the newest reply counts, and a newer error hides a valid reply."""
    reviews = materialise(_again(m.reviews, "review_id", "reviewed_at"), "several")
    rows = recommend.observations(findings.review_findings(reviews, m.review_inputs), reviews, m.pairs, m.config, m.settings)
    return rows.select("review_id", "pair_hash", "assessment", "surface", us("reviewed_at", "reviewed_us"), "review_output_hash")


@query
def results_of_several_replies(m: Model) -> DataFrame:
    """Results where each recommendation was asked for twice."""
    rows = recommend.recommendation_results(materialise(_again(m.advice, "recommendation_id", "generated_at"), "several"), m.advice_inputs)
    return rows.select("recommendation_id", "surface", "model_error", "validation_note", "citation_count", "change_mode", "headline", "review_status")


@query
def groups_of_repeated_areas(m: Model) -> DataFrame:
    """Groups while each area is there three times: the first of its queries counts."""
    areas = _union([m.areas, m.areas, m.areas.withColumn("documentation_query", F.concat(F.lit("~"), "documentation_query"))])
    rows = recommend.recommendation_groups(m.observations, m.config, areas, m.doc_latest, m.settings, True, SERVICE, AS_OF)
    return rows.select("group_id", "surface", "documentation_query", "retrieval_id", "eligibility_status")


@query
def observation_counts(m: Model) -> DataFrame:
    return m.observations.groupBy("assessment", "issue_type", "surface").agg(F.count("*").alias("saved_observations"))


def _ids(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.review_id), ",")


@query
def evidence_groups(m: Model) -> DataFrame:
    return recommend.evidence_groups(m.observations).select(*NAMES, "surface", "total_occurrences", "total_feedback_pairs", us("first_feedback_utc", "first_us"), "evidence_members_hash", _ids("selected_evidence_members").alias("sample"))


@query
def good_counterevidence(m: Model) -> DataFrame:
    return recommend.good_counterevidence(m.observations).select(*NAMES, "total_good_responses", "good_members_hash", _ids("selected_good_members").alias("sample"))


@query
def group_eligibility(m: Model) -> DataFrame:
    return m.groups.select("group_id", *NAMES, "surface", "total_occurrences", "total_good_responses", "documentation_status", "eligibility_status", "investigate_only", "target_instructions")


@query
def recommendation_candidates(m: Model) -> DataFrame:
    return m.advice_candidates.select("recommendation_id", "group_id", "surface", F.size("passages").cast("long").alias("passages"), "has_saved_result", F.col("unsaved_rank").cast("long").alias("unsaved_rank"), "is_within_budget")


@query
def input_readiness(m: Model) -> DataFrame:
    return recommend.input_readiness(m.advice_inputs, m.config, m.areas, m.doc_latest, m.settings, True, SERVICE, AS_OF)


@query
def recommendation_results(m: Model) -> DataFrame:
    return m.results.select("recommendation_id", "surface", "model_error", "validation_note", "shape_ok", "citation_count", "bad_citations", "change_mode", "headline", "review_status")


@query
def review_queue(m: Model) -> DataFrame:
    return m.queue.select("group_id", "surface", "total_occurrences", "total_good_responses", "eligibility_status", "recommendation_id", "saved_result_status", "queue_status", "validation_note")


@query
def result_history(m: Model) -> DataFrame:
    h = reports.result_history(m.results, m.advice_candidates)
    return h.groupBy("scope", "review_status").agg(F.count("*").alias("saved_result_identities"))


@query
def member_trace(m: Model) -> DataFrame:
    rows = m.observations.where(recommend.is_evidence() | (F.col("assessment") == "good")).select("surface", "member_identity.*")
    return reports.member_trace(rows, m.review_inputs)


@query
def coverage_report(m: Model) -> DataFrame:
    return reports.coverage_report(m.events, m.history, m.turns, m.pairs, m.config)


@query
def backlog_report(m: Model) -> DataFrame:
    return reports.backlog_report(m.pairs, m.config, m.candidates, m.settings, settings.settings_status(m.settings_rows, AS_OF))


@query
def saved_results_report(m: Model) -> DataFrame:
    known = findings.raw_errors(m.reviews)
    counts = m.findings.agg(F.count("*").alias("finding_rows"), *(F.count_if(F.col("validation_status") == s).alias(f"{s}_rows") for s in ("valid", "invalid_output", "ai_error")))
    return reports.one_row(known, counts)


@query
def missing_results(m: Model) -> DataFrame:
    return reports.missing_results(m.review_inputs, m.reviews, m.advice_inputs, m.advice)


@query
def duplicate_ids(m: Model) -> DataFrame:
    """Identities of the events saved twice where 50 divides the conversation, and of nothing else."""
    twice = m.events.unionByName(adapters.conversation_events(m.table("conversations").where("conv_id % 50 = 0")))
    return reports.duplicate_report({"events": (twice, "event_hash"), "history": (m.history, "snapshot_id"), "retrievals": (m.retrievals, "retrieval_id")})


@query
def digest(m: Model) -> DataFrame:
    return reports.digest(m.queue)


def _stream_input(m: Model) -> str:
    path = new_path(m.spark, "stream")
    adapters.event_spans(m.table("events")).write.parquet(f"{path}/in")
    return path


@query
def event_sample(m: Model) -> DataFrame:
    """The twenty newest events."""
    return m.events.orderBy(F.desc("event_epoch_ns"), "trace_id", "event_hash").limit(20).select("event_epoch_ns", "trace_id", "span_name", "event_hash")


@query
def turn_reader(m: Model) -> DataFrame:
    return m.turns.orderBy(*NAMES, F.asc_nulls_last("thread_id"), "turn_no").limit(40).select(*NAMES, "thread_id", "turn_no", "trace_id", "is_complete", F.size("tool_evidence").cast("long").alias("tool_spans"))


@query
def pair_reader(m: Model) -> DataFrame:
    rows = m.pairs.orderBy(F.desc("feedback_time_utc"), "response_trace_id", "feedback_trace_id").limit(20)
    return rows.select("thread_id", us("feedback_time_utc", "feedback_us"), "user_question", "followup_message", "pair_hash")


@query
def review_failures(m: Model) -> DataFrame:
    """The twenty newest findings that are not valid."""
    rows = m.findings.where("validation_status <> 'valid'").orderBy(F.desc("reviewed_at"), "review_id").limit(20)
    return rows.select("review_id", "validation_status", "validation_note", us("reviewed_at", "reviewed_us"))


@query
def latest_snapshot(m: Model) -> DataFrame:
    """The newest snapshot of all."""
    return m.history.orderBy(F.desc("captured_at"), "snapshot_id").limit(1).select("snapshot_id", *NAMES, us("captured_at", "captured_us"))


@query
def inference_batch(m: Model) -> DataFrame:
    """Inputs prepared twice: one of each id without a reply is sent, the earlier one."""
    early, late = (m.review_inputs.withColumn("prepared_at", F.lit(t).cast("timestamp_ntz")) for t in ("2024-03-30", "2024-03-31"))
    rows = workflow.inference_batch(m.all_candidates, early.unionByName(late), m.reviews, "review_id", [*NAMES])
    return rows.select("review_id", us("prepared_at", "prepared_us"))


@query
def budget_counts(m: Model) -> DataFrame:
    return workflow.counts(m.advice_candidates)


@query
def queue_counts(m: Model) -> DataFrame:
    return m.queue.groupBy("queue_status").agg(F.count("*").alias("groups"), F.sum("total_occurrences").alias("observations"))


@query
def search_statuses(m: Model) -> DataFrame:
    """Each area's query searched in the documents, its response saved, parsed and gated: the accepted passages of each area."""
    queries = m.areas.select("area_key", F.col("area_key").alias("query_id"), F.regexp_replace("area_key", "[._]", " ").alias("query_text"))
    queries = queries.withColumn("query_text", F.concat("query_text", F.lit(" the of and")))
    corpus = m.table("documents").select("doc_id", "text", F.concat(F.lit("https://d/"), F.col("doc_id").cast("string")).alias("url"), F.lit("t").alias("title"), F.col("text").alias("chunk"))
    found = search.search_passages(queries, corpus)
    saved = materialise(docs.responses(found, queries, corpus, AS_OF, SERVICE), "responses")
    passages = docs.doc_passages(saved, "https://d/")
    status = docs.doc_status(saved, passages).select("retrieval_id", "documentation_status")
    return passages.join(status, "retrieval_id").select("area_key", F.col("passage_index").cast("long").alias("passage_index"), "url", "documentation_status")


@query
def stream_capture(m: Model) -> DataFrame:
    """Capture as a stream, the same files twice: the second run adds nothing."""
    path = _stream_input(m)
    for run in ("a", "b"):
        capture.stream_capture(capture.span_stream(m.spark, f"{path}/in"), f"{path}/events", ("DB", "FEEDBACK", "web"), f"{path}/{run}").awaitTermination()
    return m.spark.read.parquet(f"{path}/events").groupBy("span_name", "status_code").agg(F.count("*").alias("events"), F.count_distinct("event_hash").alias("identities"))


@query
def stream_activity(m: Model) -> DataFrame:
    """Settled days of the stream: all but the last."""
    path = _stream_input(m)
    days = capture.stream_activity(capture.span_stream(m.spark, f"{path}/in")).select(F.unix_micros("day").alias("day_us"), "spans")
    days.writeStream.format("parquet").option("path", f"{path}/days").option("checkpointLocation", f"{path}/c").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return m.spark.read.schema("day_us long, spans long").parquet(f"{path}/days")


def _settings_cases(m: Model) -> dict[str, DataFrame]:
    """The made rows, none of them, and the one valid row."""
    made = _made_settings(m)
    return {"made": made, "none": made.where("review_start < timestamp_ntz'1900-01-01'"), "one": m.settings_rows}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query
def settings_statuses(m: Model) -> DataFrame:
    """Of a table of many rows, of an empty one and of a valid one; rows are counted before any filter."""
    return _union([settings.settings_status(rows, AS_OF).select(F.lit(k).alias("case"), "*") for k, rows in _settings_cases(m).items()])


@query
def settings_reports(m: Model) -> DataFrame:
    names = ["settings_rows", "area_rows", "areas_complete", "one_settings_row_keyed_one", *list(settings.checks(AS_OF))[1:], "configuration_status"]
    return _union([
        settings.settings_report(rows, m.areas, AS_OF).select(F.lit(k).alias("case"), us("review_start", "start_us"), us("review_end", "end_us"), *names)
        for k, rows in _settings_cases(m).items()
    ])


def _made_areas(m: Model) -> DataFrame:
    """An area made of each page, with titles for descriptions."""
    area = F.element_at(F.array(*map(F.lit, (*settings.AREAS, "other"))), (F.col("page_id") % 9 + 1).cast("int"))
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    return m.table("pages").select(area.alias("area_key"), F.when(F.col("page_id") % 5 > 0, title).otherwise(" ").alias("area_description"), F.when(F.col("page_id") % 7 > 0, "q").alias("documentation_query"))


@query
def areas_statuses(m: Model) -> DataFrame:
    """Of the areas and of one made of each page."""
    return _union([settings.areas_status(rows).select(F.lit(k).alias("case"), "*") for k, rows in (("areas", m.areas), ("pages", _made_areas(m)))])


@query
def settings_numbers(m: Model) -> DataFrame:
    """Of a table of many rows with an area of each page, of an empty one and of the valid row."""
    areas = {"made": _made_areas(m), "none": _made_areas(m).where("area_key is null"), "one": m.areas}
    return _union([
        settings.settings_numbers(rows, areas[k]).select(F.lit(k).alias("case"), us("review_start", "start_us"), us("review_end", "end_us"), "*").drop("review_start", "review_end")
        for k, rows in _settings_cases(m).items()
    ])


@query
def seeds(m: Model) -> DataFrame:
    """What is added to a table without rows and to one with rows."""
    tables = {"empty": m.history.where("captured_at < timestamp_ntz'1990-01-01'"), "filled": m.history}
    return _union([settings.seed_if_empty(t, m.areas).select(F.lit(k).alias("case"), "area_key", "documentation_query") for k, t in tables.items()])


@query
def spans_from_files(m: Model) -> DataFrame:
    """Raw spans written as JSON lines and read with the declared schema."""
    path = new_path(m.spark, "spans")
    adapters.event_spans(m.table("events")).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    rows = spans.readable_events(spans.read_spans(m.spark, path, "json"), ("DB", "FEEDBACK", "web"))
    return spans.with_event_hash(rows).select("event_hash", "span_id", "thread_id", "agent_answer", "event_epoch_ns")


@query
def spans_of_days(m: Model) -> DataFrame:
    """Raw spans saved by day in two runs, and those of three days and two half ones read again."""
    path = new_path(m.spark, "days")
    for run in ("event_id % 3 = 0", "event_id % 3 > 0"):
        spans.write_daily(adapters.event_spans(m.table("events").where(run)), path)
    window = replace(m.settings, review_start=datetime(2024, 1, 5, 12), review_end=datetime(2024, 1, 9, 6))
    rows = spans.readable_events(spans.read_daily(m.spark, path, window), ("DB", "FEEDBACK", "web"))
    return spans.with_event_hash(rows).select("event_hash", "span_id", "thread_id", "event_epoch_ns")


@query
def snapshots_appended(m: Model) -> DataFrame:
    """The history after each agent's current settings are captured again."""
    new = materialise(spans.snapshot(m.config.select(*NAMES, "captured_at", "specification")), "snapshot")
    rows = m.history.unionByName(new)
    return rows.groupBy(*NAMES).agg(F.count("*").alias("snapshots"), F.count_distinct("snapshot_id").alias("identities"), F.count_if(F.char_length("snapshot_id") == 36).alias("captured_again"))


def _other_window(m: Model) -> settings.Settings:
    return replace(m.settings, review_start=datetime(2023, 1, 1), review_end=datetime(2023, 2, 1))


@query
def preflights(m: Model) -> DataFrame:
    """Of the window, of one without events and without valid settings: a row each."""
    cases = {"window": m.settings, "empty": _other_window(m), "invalid": None}
    return _union([reports.preflight(m.turns, s).select(F.lit(k).alias("case"), "*") for k, s in cases.items()])


@query
def backlog_reports(m: Model) -> DataFrame:
    """With valid and with invalid settings: then all numbers are null."""
    bad = settings.settings_status(_made_settings(m), AS_OF)
    good = settings.settings_status(m.settings_rows, AS_OF)
    return _union([reports.backlog_report(m.pairs, m.config, m.candidates, s, status) for s, status in ((m.settings, good), (None, bad))])


@query
def review_queue_invalid(m: Model) -> DataFrame:
    """The queue while the settings are invalid: one more row, without a group."""
    bad = settings.settings_status(_made_settings(m), AS_OF).select(F.col("settings_are_valid").alias("ok"))
    q = recommend.review_queue(m.groups, m.advice_candidates, m.results, bad)
    return q.select("group_id", "surface", "total_occurrences", "total_good_responses", "eligibility_status", "recommendation_id", "saved_result_status", "queue_status", "validation_note")


@query
def review_prompts(m: Model) -> DataFrame:
    """Each prompt taken apart again, and whether its hash is that of its bytes."""
    policy = findings.Policy()
    data = F.substr("prompt_text", F.lit(len(policy.template) + 1))
    at_ = lambda path: F.get_json_object(data, path)
    return m.all_candidates.select(
        "review_id", (F.sha2("prompt_text", 256) == F.col("prompt_hash")).alias("hash_ok"), F.substr("prompt_text", F.lit(1), F.lit(len(policy.template))).alias("template"),
        at_("$.evidence.followup_turn.user_question").alias("followup_message"), F.json_array_length(at_("$.evidence.prior_turns")).cast("long").alias("context_turns"),
        at_("$.evidence.response_trace_id").alias("response_trace_id"), at_("$.capture_time_configuration").alias("configuration"),
    )


def follow_up_scorer(prompt: str) -> str:
    """A reply that holds the follow-up's length; some calls fail."""
    said = json.loads(prompt[prompt.index("{") :])["evidence"]["followup_turn"]["user_question"]
    if len(said) % 3 == 0:
        raise ValueError("timeout")
    return json.dumps({"chars": len(said)})


@query
def review_runs(m: Model) -> DataFrame:
    """Two runs of the review step from empty tables, the second over what the first left: saved replies with their inputs."""
    cols = ["review_id", "pair_hash", *NAMES, "prompt_hash", "prompt_text"]
    inputs = m.all_candidates.select(*cols, F.col("feedback_time_utc").alias("prepared_at")).where(F.lit(False))
    replies = m.spark.createDataFrame([], "review_id string, reviewed_at timestamp_ntz, model_response string")
    for at_ in (AS_OF, AS_OF + timedelta(days=1)):
        rows = work.not_saved(m.all_candidates, replies, "review_id").select(*cols, "feedback_time_utc")
        inputs, replies = workflow.run_reviews(rows, inputs, replies, m.settings.max_new_reviews, at_, follow_up_scorer)
    saved = replies.join(inputs.select("review_id", "prepared_at"), "review_id")
    value, error = F.get_json_object("model_response", "$.value.chars").cast("long"), F.get_json_object("model_response", "$.error")
    return saved.select("review_id", us("prepared_at", "prepared_us"), us("reviewed_at", "reviewed_us"), value.alias("chars"), error.alias("error"))


@query
def logged_runs(m: Model) -> DataFrame:
    """Three runs of the review step over logs of runs. The second one ends when its inputs are published and its replies are
    half written; it is called again four days later, and once more after it is done. Replies with the runs that hold them."""
    cols = ["review_id", "pair_hash", *NAMES, "prompt_hash", "prompt_text"]
    path = new_path(m.spark, "logs")
    schemas = {
        "inputs": m.all_candidates.select(*cols, F.col("feedback_time_utc").alias("prepared_at")).schema,
        "replies": m.spark.createDataFrame([], "review_id string, reviewed_at timestamp_ntz, model_response string").schema,
    }
    inputs, replies = (runlog.RunLog(m.spark, f"{path}/{k}", schema) for k, schema in schemas.items())
    lost = runlog.RunLog(m.spark, f"{path}/lost", schemas["replies"])

    def run(name: str, days: int, to: runlog.RunLog = replies) -> bool:
        queue = work.not_saved(m.all_candidates, replies.read(), "review_id").select(*cols, "feedback_time_utc")
        return workflow.run_logged(name, queue, inputs, to, "review_id", ["feedback_time_utc", "review_id"], m.settings.max_new_reviews, [*NAMES], AS_OF + timedelta(days=days), follow_up_scorer)

    run("r1", 0)
    run("r2", 1, lost)
    replies.write(lost.read(), "r2")
    done = [run("r2", 5), run("r2", 9), run("r3", 6)]
    assert done == [True, False, True]
    held = _union([replies.read(r).withColumn("run", F.lit(r)) for r in replies.runs()]).join(inputs.read().select("review_id", "prepared_at"), "review_id")
    value, error = F.get_json_object("model_response", "$.value.chars").cast("long"), F.get_json_object("model_response", "$.error")
    return held.select("run", "review_id", us("prepared_at", "prepared_us"), us("reviewed_at", "reviewed_us"), value.alias("chars"), error.alias("error"))


def _fresh(m: Model, inputs: DataFrame, **other: Any) -> DataFrame:
    now = {"config": m.config, "as_of": AS_OF, "settings": m.settings} | other
    return recommend.input_readiness(inputs, now["config"], m.areas, m.doc_latest, now["settings"], True, SERVICE, now["as_of"])


@query
def recommendation_runs(m: Model) -> DataFrame:
    """One run of the recommendation step from empty tables, while the configuration of one agent is no longer current."""
    none = m.spark.createDataFrame([], "recommendation_id string, generated_at timestamp_ntz, model_response string")
    cols = ["recommendation_id", "group_id", *NAMES, "surface", "config_hash", "service_name", "documentation_query", "docs_content_hash", "prompt_revision", "instruction_template_hash", "sample_policy", "prompt_hash", "prompt_text"]
    inputs = m.all_advice.select(*cols, F.col("first_feedback_utc").alias("prepared_at")).where(F.lit(False))
    current = m.config.where("agent_name <> 'agent1'")
    inputs, replies = workflow.run_recommendations(m.all_advice, inputs, none, AS_OF, lambda p: json.dumps({"ok": p.startswith("Propose")}), lambda rows: _fresh(m, rows, config=current))
    done = replies.select("recommendation_id", us("generated_at", "generated_us"), F.get_json_object("model_response", "$.value.ok").alias("ok"))
    return inputs.select("recommendation_id", "agent_name", us("prepared_at", "prepared_us")).join(done, "recommendation_id", "left")


@query
def readiness_refusals(m: Model) -> DataFrame:
    """Saved inputs that are as they were, and such as name what is no longer so: how many of each may be sent."""
    other = F.lit("other")
    cases = {
        "same": {}, "config": {"config_hash": other}, "query": {"documentation_query": other}, "documents": {"docs_content_hash": other},
        "revision": {"prompt_revision": other}, "service": {"service_name": other},
    }
    ids = {k: F.concat("recommendation_id", F.lit(f"|{k}")) for k in cases}
    rows = _union([m.all_advice.withColumns({**changed, "recommendation_id": ids[k]}) for k, changed in cases.items()])
    rows = materialise(rows.select("recommendation_id", *NAMES, "surface", "config_hash", "documentation_query", "docs_content_hash", "prompt_revision", "service_name"), "inputs")
    late = rows.where("recommendation_id like '%|same'").withColumn("recommendation_id", F.replace("recommendation_id", F.lit("|same"), F.lit("|late")))
    ready = _fresh(m, rows).unionByName(_fresh(m, late, as_of=AS_OF + timedelta(days=60))).unionByName(_fresh(m, late, settings=None)).withColumn("ready", F.lit(True))
    every = rows.unionByName(late).select("recommendation_id").join(ready, "recommendation_id", "left")
    return every.groupBy(F.substring_index("recommendation_id", "|", -1).alias("case")).agg(F.count("*").alias("inputs"), F.count("ready").alias("ready"))


#: What a reply's reasoning says, and the notes on it for a gap and for other areas.
GUARDED = (
    ("plain", "look at the table", None, None), ("statement", "then drop it", "executable statement", "executable statement"), ("inside", "a raindrop fell", None, None),
    ("underscore", "call my_drop it", "executable statement", "executable statement"), ("under", "my_drop it", None, None), ("fence", "```SQL select 1```", "executable statement", "executable statement"),
    ("word", "It is Verified.", "confirmation wording", None), ("part", "still unverified", None, None), ("mail", "ask a@b", "contact", None),
)


@query
def text_guards(m: Model) -> DataFrame:
    """Replies to each input that differ in their reasoning: what the text rules say."""
    gap, first = F.col("investigate_only"), F.element_at("passages", 1)
    text = lambda on, off="": F.when(gap, on).otherwise(off)
    cited = F.array(F.struct(first.url.alias("url"), F.left(first.chunk, F.lit(10)).alias("quote"), F.lit("it").alias("supports")))
    cases = m.spark.createDataFrame([g[:2] for g in GUARDED], "case string, said string")
    inputs = m.all_advice.crossJoin(F.broadcast(cases)).withColumn("recommendation_id", F.concat("recommendation_id", F.lit("|"), "case"))
    inputs = materialise(inputs, "guarded")
    value = F.struct(
        F.lit(True).alias("recommendation_warranted"), F.lit("h").alias("headline"), F.col("said").alias("reasoning"), F.lit("look").alias("suggested_change"), F.lit("investigate").alias("change_mode"),
        F.lit("").alias("displaced_text"), F.lit("rest").alias("preserve_behavior"), F.lit(False).alias("would_regress_good_behavior"), F.lit("low").alias("confidence"),
        text("look").alias("data_gap_investigation"), text("say so").alias("unknown_data_response_guidance"), cited.alias("citations"),
    )
    replies = inputs.select("recommendation_id", settings.now(AS_OF).alias("generated_at"), F.to_json(F.struct(value.alias("value"))).alias("model_response"))
    return recommend.recommendation_results(replies, inputs).select("recommendation_id", "case", "shape_ok", "validation_note", "review_status")


#: What a reply that is else right has instead, and whether these fields are told of a gap only.
CHECKED = (
    ("right", {}), ("shape", {"headline": " "}), ("unwarranted mode", {"recommendation_warranted": False}), ("no reason", {"reasoning": "\t"}), ("no citation", {"citations": None}),
    ("other quote", {"citations": "not there"}), ("replacement", {"change_mode": "replace", "displaced_text": "zzz"}), ("displaced", {"displaced_text": "x"}), ("append", {"change_mode": "append"}),
    ("same actions", {"data_gap_investigation": " Look", "unknown_data_response_guidance": "look "}), ("gap fields", {"data_gap_investigation": "a", "unknown_data_response_guidance": "b"}),
    ("regression", {"would_regress_good_behavior": True}),
    ("unwarranted", {"recommendation_warranted": False, "change_mode": "none", "data_gap_investigation": "", "unknown_data_response_guidance": ""}),
)


@query
def advice_checks(m: Model) -> DataFrame:
    """Replies to each input that each break one rule of shape, warrant, citations, replacement or gap, and right ones."""
    gap, first = F.col("investigate_only"), F.element_at("passages", 1)
    right = {
        "recommendation_warranted": True, "headline": "h", "reasoning": "seen", "suggested_change": "look", "change_mode": "investigate", "displaced_text": "", "preserve_behavior": "rest",
        "would_regress_good_behavior": False, "confidence": "low", "data_gap_investigation": F.when(gap, "look").otherwise(""), "unknown_data_response_guidance": F.when(gap, "say so").otherwise(""),
    }
    column = lambda v: v if isinstance(v, Column) else F.lit(v)
    cited = lambda quote: F.array(F.struct(first.url.alias("url"), quote.alias("quote"), F.lit("it").alias("supports")))

    def reply(name: str, changed: dict[str, Any]) -> Column:
        own = right | {k: v for k, v in changed.items() if k != "citations"}
        quotes = cited(F.left(first.chunk, F.lit(10)) if "citations" not in changed else F.lit(changed["citations"]))
        quotes = F.filter(quotes, lambda c: c.quote.isNotNull())
        value = F.struct(*(column(v).alias(k) for k, v in own.items()), quotes.alias("citations"))
        return F.struct(F.lit(name).alias("case"), F.to_json(F.struct(value.alias("value"))).alias("model_response"))

    inputs = m.all_advice.withColumn("r", F.explode(F.array(*(reply(*c) for c in CHECKED)))).select("*", "r.*").drop("r")
    inputs = materialise(inputs.withColumn("recommendation_id", F.concat("recommendation_id", F.lit("|"), "case")), "checked")
    replies = inputs.select("recommendation_id", settings.now(AS_OF).alias("generated_at"), "model_response")
    return recommend.recommendation_results(replies, inputs.drop("model_response")).select("recommendation_id", "case", "surface", "shape_ok", "citation_count", "bad_citations", "validation_note", "review_status")


@query
def duplicate_ids_of_all(m: Model) -> DataFrame:
    """Identities saved more than once in any of the seven saved tables, some of whose rows are saved again here."""
    again = lambda df, where: df.unionByName(df.where(where))
    tables = {
        "agent_events": (again(m.events.select("event_hash"), "substr(event_hash, 1, 2) = '00'"), "event_hash"), "agent_settings_history": (again(m.history.select("snapshot_id"), "snapshot_id like '%99'"), "snapshot_id"),
        "documentation_retrievals": (again(m.retrievals.select("retrieval_id"), "retrieval_id like '%5'"), "retrieval_id"), "answer_review_inputs": (again(m.review_inputs.select("review_id"), "review_id like '%a'"), "review_id"),
        "answer_reviews": (again(m.reviews.select("review_id"), "review_id like '%b'"), "review_id"), "recommendation_inputs": (again(m.advice_inputs.select("recommendation_id"), "true"), "recommendation_id"),
        "recommendations": (again(m.advice.select("recommendation_id"), "recommendation_id like '%c'"), "recommendation_id"),
    }
    return reports.duplicate_report(tables)


@query
def raw_review_errors(m: Model) -> DataFrame:
    """The twenty newest saved replies that hold an error."""
    error = F.get_json_object("model_response", "$.error")
    rows = m.reviews.select("review_id", "reviewed_at", error.alias("error")).where("error is not null")
    return rows.orderBy(F.desc("reviewed_at"), "review_id").limit(20).select("review_id", us("reviewed_at", "reviewed_us"), "error")


@query
def replies_without_input(m: Model) -> DataFrame:
    """Saved replies whose inputs are gone, where those of some ids are taken away."""
    left = m.review_inputs.where("substr(review_id, 5, 1) not in ('0', '1', '2')").select("review_id")
    return reports.count_of(m.reviews.join(left, "review_id", "left_anti"), "review_rows_without_input")


@query
def stream_traces(m: Model) -> DataFrame:
    """Settled days of the stream with their approximate number of traces, within a tenth of the exact one or not."""
    path = _stream_input(m)
    days = capture.stream_activity(capture.span_stream(m.spark, f"{path}/in"))
    days.writeStream.format("parquet").option("path", f"{path}/days").option("checkpointLocation", f"{path}/c").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    found = m.spark.read.schema("day timestamp, spans long, traces long").parquet(f"{path}/days")
    trace = F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMddHH"))
    exact = m.table("events").groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")).agg(F.count_distinct(trace).alias("exact"))
    return found.join(exact, "day").select(F.unix_micros("day").alias("day_us"), "exact", (F.abs(F.col("traces") - F.col("exact")) <= F.col("exact") / 10).alias("close"))
