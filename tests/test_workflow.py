"""Anchors on a hand-made fixture: turns, pairs, gates, masks and identities."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewise.functions import variants
from tracewise.functions.hashing import AGENT, NO_ITEMS
from tracewise.operators import config, docs, findings, recommend, reports, settings, turns, work, workflow
from tracewise.functions.variants import canonical_nodes
from tracewise.sources import adapters, scratch, spans
from tracewise.sources.spans import new_events, with_event_hash
from tracewise.streaming import capture

BASE = datetime(2024, 1, 1)
BASE_NS = 1_704_067_200_000_000_000
AS_OF = BASE + timedelta(days=2)
COLS = ("agent_name", "t", "trace_id", "span_id", "span_name", "span_type", "thread_id", "message_id", "user_question", "agent_answer", "tool_name", "executed_sql", "chart_definition", "status_code")


def event(agent, t, trace, span="root", kind="record_root", thread="core", q=None, a=None, name=None, tool=None):
    return (agent, BASE_NS + int(t * 10**9), trace, span, name, kind, thread, None, q, a, tool, None, None, None)


def core(agent):
    return [event(agent, i, f"t{i:02}", q=f"Question {i}.", a=f"Answer {i}.") for i in range(1, 16)]


def edges():
    a = "A"
    full = {"q": "Q?", "a": "A."}
    rows = [event(a, -100 + i, f"b{i}", thread="broken", q="  " if i == 2 else "Q?", a="A.") for i in range(1, 5)]
    for n, (trace, thread) in enumerate([("n1", None), ("n2", None), ("z1", "0"), ("z2", "0"), ("w1", " \t"), ("w2", "")]):
        rows.append(event(a, -90 + n, trace, thread=thread, **full))
    rows += [event(a, -80, "e1", thread="edge", q="Q?", a=" \n"), event(a, -79, "e2", thread="edge", q="Q?", a="[REDACTED] "), event(a, -78, "e3", thread="edge", a="A.")]
    # Three roots of one trace: two tie by time, the larger span wins; the question is the earliest usable one.
    rows += [event(a, -70, "d1", "d-a", thread="dup", q="Earliest question.", a="Older."), event(a, -69, "d1", "d-y", thread="dup", q="Later.", a="Tied."), event(a, -69, "d1", "d-z", thread="dup", q="Last.", a="Selected answer.")]
    rows += [event(a, 1, "t01", "skill", "step", name="SkillTool_x"), event(a, 1, "t01", "chart", "step", name="ChartTool-1"), event(a, 1, "orphan", "s", "step", name="SkillTool_y")]
    return rows


def saved(spark, rows):
    df = spark.createDataFrame(rows, "agent_name string, event_epoch_ns long, trace_id string, span_id string, span_name string, span_type string, thread_id string, message_id string, user_question string, agent_answer string, tool_name string, executed_sql string, chart_definition string, status_code string")
    return with_event_hash(df.withColumns({AGENT[0]: F.lit("D"), AGENT[1]: F.lit("S")}))


@pytest.fixture(scope="module")
def events(spark):
    return saved(spark, core("A") + core("B") + edges()).cache()


@pytest.fixture(scope="module")
def all_turns(events):
    return turns.conversation_turns(events).cache()


@pytest.fixture(scope="module")
def pairs(all_turns):
    return turns.answer_followup_pairs(all_turns).cache()


def test_turns(all_turns):
    rows = {(r["agent_name"], r["trace_id"]): r for r in all_turns.collect()}
    assert len(rows) == 30 + 4 + 6 + 3 + 1
    assert len({r["turn_hash"] for r in rows.values()}) == len(rows)
    assert [k for k, r in rows.items() if not r["is_complete"]].__len__() == 4
    assert sum(r["thread_id"] is None for r in rows.values()) == 6
    assert rows["A", "b2"]["turn_no"] == 2 and rows["A", "b4"]["turn_no"] == 4
    d = rows["A", "d1"]
    assert (d["user_question"], d["agent_answer"]) == ("Earliest question.", "Selected answer.")
    assert [t["span_id"] for t in rows["A", "t01"]["tool_evidence"]] == ["chart", "skill"]
    assert sorted(r["turn_no"] for r in rows.values() if r["thread_id"] is None) == [1, 2, 3, 4, 5, 6]


def test_pairs(pairs):
    rows = pairs.collect()
    assert len(rows) == len({r["pair_hash"] for r in rows}) == 14 * 2 + 1
    assert [f"{r['response_trace_id']}>{r['feedback_trace_id']}" for r in rows if r["thread_id"] == "broken"] == ["b3>b4"]
    last = next(r for r in rows if r["agent_name"] == "A" and r["feedback_trace_id"] == "t15")
    context = [t["trace_id"] for t in last["evidence"]["prior_turns"]]
    assert context == [f"t{i:02}" for i in range(9, 15)]
    assert not any(r["response_trace_id"] == "t15" for r in rows)
    broken = next(r for r in rows if r["thread_id"] == "broken")
    assert [t["trace_id"] for t in broken["evidence"]["prior_turns"]] == ["b1", "b3"]


def test_unjudged(all_turns, pairs):
    found = {r["trace_id"] for r in turns.unjudged_answers(all_turns, pairs).where("agent_name = 'A'").collect()}
    assert found == {"t15", "b1", "b4", "d1"}
    assert turns.unjudged_answers(all_turns, pairs, False).count() == 1 + len(found) + 6


def test_events_of_empty_tables(spark, events):
    none = events.limit(0)
    assert turns.answer_followup_pairs(turns.conversation_turns(none)).count() == 0
    assert reports.preflight(turns.conversation_turns(none), None).first()["verdict"] == "invalid_settings"


def test_one_changed_span_changes_the_pairs_that_see_it(spark, pairs):
    rows = core("A")
    rows[9] = event("A", 10, "t10", q="Question 10.", a="Changed.")
    other = turns.answer_followup_pairs(turns.conversation_turns(saved(spark, rows)))
    before = pairs.where("agent_name = 'A' and thread_id = 'core'").select("pair_hash")
    # t01's tool spans are left out here, so that its seven pairs differ as well.
    changed = {r["feedback_trace_id"] for r in other.join(before, "pair_hash", "left_anti").collect()}
    assert {f"t{i}" for i in range(10, 16)} <= changed and changed <= {f"t{i:02}" for i in [*range(2, 8), *range(10, 16)]}


def test_capture_is_insert_only(events):
    doubled = events.unionByName(events)
    assert new_events(doubled, events.limit(0)).count() == events.count()
    assert new_events(doubled, events).count() == 0


def test_session_zone_does_not_move_times(spark, events):
    want = turns.conversation_turns(events).agg(F.min("event_time_utc").cast("string")).first()[0]
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert turns.conversation_turns(events).agg(F.min("event_time_utc").cast("string")).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def settings_rows(spark, *changes):
    good = {"settings_id": 1, "review_start": BASE, "review_end": BASE + timedelta(days=1), "thread_filter": None, "max_new_reviews": 1, "max_new_recommendations": 1, "min_occurrences": 1, "docs_max_age_hours": 168, "prompt_revision": "v1"}
    return spark.createDataFrame([tuple((good | c).values()) for c in changes], settings.SETTINGS_SCHEMA)


@pytest.mark.parametrize(("change", "check"), [
    ({"settings_id": 2}, "keyed_one"), ({"review_end": BASE}, "window_runs_forward"), ({"review_end": AS_OF}, "window_end_settled"), ({"review_start": BASE - timedelta(days=90)}, "window_span_sensible"),
    ({"thread_filter": " 0 "}, "thread_filter_usable"), ({"max_new_reviews": 101}, "reviews_cap_sensible"), ({"max_new_recommendations": 0}, "recommendations_cap_sensible"), ({"min_occurrences": None}, "occurrences_sensible"),
    ({"docs_max_age_hours": 721}, "docs_age_sensible"), ({"prompt_revision": "\t\n"}, "prompt_revision_present"),
])
def test_settings_checks(spark, change, check):
    rows = settings_rows(spark, change)
    checked = settings.checked_settings(rows, AS_OF).first()
    assert [c for c in settings.checks(AS_OF) if not checked[c]] == [check]
    assert settings.read_settings(rows, AS_OF) is None
    assert not settings.settings_status(rows, AS_OF).first()["settings_are_valid"]


def areas(spark, n=8):
    return spark.createDataFrame([(a, "d", f"about {a}") for a in settings.AREAS[:n]], "area_key string, area_description string, documentation_query string")


def test_settings_guard_counts_before_it_filters(spark):
    one, two, none = settings_rows(spark, {}), settings_rows(spark, {}, {"settings_id": 2}), settings_rows(spark, {}).limit(0)
    assert settings.read_settings(one, AS_OF).max_new_reviews == 1
    assert settings.read_settings(two, AS_OF) is None and settings.read_settings(none, AS_OF) is None
    assert settings.settings_status(none, AS_OF).first()["settings_rows"] == 0
    assert settings.settings_report(one, areas(spark), AS_OF).first()["configuration_status"] == "ready"
    assert settings.settings_report(none, areas(spark, 7), AS_OF).first()["configuration_status"].startswith("stop")
    assert settings.areas_status(areas(spark)).first()["areas_are_valid"] and not settings.areas_status(areas(spark).unionByName(areas(spark, 1))).first()["areas_are_valid"]
    assert settings.seed_if_empty(none, one).count() == 1 and settings.seed_if_empty(one, one).count() == 0


def history(spark, *rows):
    return spark.createDataFrame([(f"s{i}", BASE + timedelta(hours=i), "D", "S", agent, spec) for i, (agent, spec) in enumerate(rows)], f"snapshot_id string, captured_at timestamp_ntz, {AGENT[0]} string, {AGENT[1]} string, {AGENT[2]} string, specification string")


def test_config_identity(spark):
    h = history(spark, ("A", '{"a": 1, "b": {"c": [1, "x"], "d": {}}}'), ("B", '{"b": {"d": {}, "c": [1, "x"]}, "a": 1}'), ("C", '{"a": 1, "b": {"c": [1, "x"], "d": []}}'), ("BAD", '{"a": 1}'), ("BAD", "[]"), ("E", "{}"), ("N", "null"))
    rows = {r["agent_name"]: r for r in config.current_config(h).collect()}
    assert rows["A"]["config_hash"] == rows["B"]["config_hash"] != rows["C"]["config_hash"]
    assert rows["BAD"]["config_hash"] is None and not rows["BAD"]["specification_is_valid"]
    assert rows["E"]["specification_is_valid"] and rows["E"]["config_hash"] and not rows["N"]["specification_is_valid"]


def test_strict_types(spark):
    df = spark.createDataFrame([('{"a": 42}',), ('{"a": "42"}',), ('{"a": null}',), ("{}",), ("[1]",), ("oops",), (None,)], "j string")
    v = F.try_parse_json(F.col("j"))
    assert [r[0] for r in df.select(variants.string(v, "$.a")).collect()] == [None, "42", None, None, None, None, None]
    assert [r[0] for r in df.select(variants.absent(v, "$.a")).collect()] == [False, False, True, True, True, True, True]


@pytest.fixture(scope="module")
def one_config(spark):
    return config.current_config(history(spark, ("A", '{"instructions": {"response": "Be brief."}}'), ("B", '{"instructions": {"response": "Be brief."}}'))).cache()


def test_candidates_window_filter_and_identity(spark, pairs, one_config):
    none = spark.createDataFrame([], "review_id string")
    run = lambda **c: findings.review_candidates(pairs, one_config, none, settings.read_settings(settings_rows(spark, c), AS_OF))
    all_ = run()
    assert all_.count() == 28
    assert run(thread_filter=" core ").count() == 28 and run(thread_filter=" ").count() == 0
    small = run(review_start=BASE + timedelta(seconds=2), review_end=BASE + timedelta(seconds=3))
    assert {r["feedback_trace_id"] for r in small.collect()} == {"t02"} and small.count() == 2
    ids = {r["review_id"] for r in all_.collect()}
    assert {r["review_id"] for r in run(max_new_reviews=50).collect()} == ids
    assert not ids & {r["review_id"] for r in run(prompt_revision="v2").collect()}
    batch = work.batch(all_, ["feedback_time_utc", "review_id"], 1, "rank")
    rest = findings.review_candidates(pairs, one_config, batch, settings.read_settings(settings_rows(spark, {}), AS_OF))
    assert batch.count() == 1 and rest.count() == 27
    counts = findings.queue_counts(all_, settings.read_settings(settings_rows(spark, {}), AS_OF)).first()
    assert (counts["eligible_reviews"], counts["reviews_this_run"], counts["deferred_reviews"]) == (28, 1, 27)


GOOD = {"assessment": "good", "issue_type": "none", "severity": "low", "surface": "none", "observation": "o", "evidence_quote": "Answer", "suspected_cause": "", "preserve_behavior": ""}


def reply(**changes):
    import json

    return json.dumps({"value": GOOD | changes, "error": None})


def test_findings(spark, pairs, one_config):
    s = settings.read_settings(settings_rows(spark, {}), AS_OF)
    inputs = findings.review_candidates(pairs, one_config, spark.createDataFrame([], "review_id string"), s).where("agent_name = 'A'").cache()
    ids = [r["review_id"] for r in inputs.orderBy("feedback_time_utc").collect()]
    cases = [
        (reply(), "valid"), (reply(evidence_quote="invented"), "invalid_output"), (reply(surface="roof"), "invalid_output"), ('{"value": null, "error": "boom"}', "ai_error"), (reply(observation=" "), "invalid_output"),
        (reply(severity=1), "invalid_output"), ('{"value": [], "error": null}', "invalid_output"), ('{"value": {}, "error": 5}', "invalid_output"), (reply(suspected_cause=None), "invalid_output"), ("[]", "invalid_output"), (None, "invalid_output"),
        (reply(evidence_quote="Question 13"), "valid"),
    ]
    reviews = spark.createDataFrame([(i, AS_OF, c[0]) for i, c in zip(ids, cases)], "review_id string, reviewed_at timestamp_ntz, model_response string")
    got = {r["review_id"]: r["validation_status"] for r in findings.review_findings(reviews, inputs).collect()}
    assert [got[i] for i, _ in zip(ids, cases)] == [c[1] for c in cases]
    raw = findings.raw_errors(reviews).first()
    assert (raw["raw_review_rows"], raw["raw_error_rows"], raw["nonobject_envelopes"]) == (12, 2, 2)
    # A newer error hides an older valid review.
    seen = lambda r: recommend.observations(findings.review_findings(r, inputs), r, pairs, one_config, s).count()
    assert seen(reviews) == 2
    newer = spark.createDataFrame([(ids[0], AS_OF + timedelta(hours=1), '{"value": null, "error": "late"}')], reviews.schema)
    assert seen(reviews.unionByName(newer)) == 1


def test_scoring_keeps_errors(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], "id string, p string")

    def scorer(p):
        return str(int(p) + 1)

    out = {r["id"]: r["model_response"] for r in work.envelopes(work.score_rows(rows, "id", "p", scorer), "id").collect()}
    assert out["a"] == '{"value":2,"error":null}' and "invalid literal" in out["b"] and out["c"].startswith('{"value":null,"error":"')


def retrievals(spark, *rows):
    data = [(f"r{i}", BASE + timedelta(hours=h), area, service, query, response) for i, (h, area, service, query, response) in enumerate(rows)]
    return spark.createDataFrame(data, "retrieval_id string, captured_at timestamp_ntz, area_key string, service_name string, query_text string, response string")


def found(*urls, chunk="c"):
    import json

    return json.dumps({"results": [{"url": u, "title": "t", "chunk": chunk} for u in urls]})


@pytest.mark.parametrize(("response", "status"), [
    (None, "malformed"), ("[]", "malformed"), ("{}", "malformed"), ('{"results": []}', "empty"), ('{"results": [], "error": "x"}', "error"), ('{"results": [], "error": null}', "empty"),
    ('{"results": [{"url": 1, "title": "t", "chunk": "c"}]}', "rejected"), ('{"results": [{"url": "https://d/1", "title": "t", "chunk": 2}]}', "rejected"), (found("https://evil/https://d/"), "rejected"),
    (found("http://d/1"), "rejected"), (found("https://d/a b"), "rejected"), (found("https://d/\\x"), "rejected"), (found("https://d/1", chunk=" "), "rejected"), (found("https://d/" + "x" * 2048), "rejected"), (found("https://d/1", "no"), "ready"),
])
def test_doc_status(spark, response, status):
    r = retrievals(spark, (0, "data", "s", "q", response))
    p = docs.doc_passages(r, "https://d/")
    assert docs.doc_status(r, p).first()["documentation_status"] == status


def test_doc_latest_ranks_before_status_and_hashes_content(spark):
    r = retrievals(spark, (0, "data", "s", "q", found("https://d/1", "https://d/2")), (1, "data", "s", "q", "{}"), (0, "skills", "s", "q", found("https://d/2", "https://d/1")), (0, "skills", "other", "q", found("https://d/1")))
    p = docs.doc_passages(r, "https://d/")
    latest = {(x["area_key"], x["service_name"]): x for x in docs.doc_latest(docs.doc_status(r, p), p).collect()}
    assert latest["data", "s"]["documentation_status"] == "malformed" and latest["data", "s"]["content_hash"] == NO_ITEMS
    both = retrievals(spark, (0, "data", "s", "q", found("https://d/1", "https://d/2")))
    p2 = docs.doc_passages(both, "https://d/")
    assert docs.doc_latest(docs.doc_status(both, p2), p2).first()["content_hash"] == latest["skills", "s"]["content_hash"]
    a = areas(spark)
    state = {x["area_key"]: x["query_alignment"] for x in docs.doc_alignment(a, docs.doc_latest(docs.doc_status(r, p), p), "s").collect()}
    assert state["data"] == "query_mismatch" and state["semantic_view"] == "not_retrieved"
    gate = {x["area_key"]: x["input_status"] for x in docs.doc_readiness(a, docs.doc_latest(docs.doc_status(r, p), p), None, "s", AS_OF).collect()}
    assert set(gate.values()) == {"invalid_settings"} and len(gate) == 8


def advice(**changes):
    import json

    value = {"recommendation_warranted": True, "headline": "h", "reasoning": "r", "suggested_change": "s", "change_mode": "append", "displaced_text": "", "preserve_behavior": "p", "would_regress_good_behavior": False,
             "confidence": "low", "data_gap_investigation": "", "unknown_data_response_guidance": "", "citations": [{"url": "https://d/1", "quote": "quote", "supports": "x"}]}
    value = {k: v for k, v in (value | changes).items() if v != "drop"}
    return json.dumps({"value": value, "error": None})


GAP = {"change_mode": "investigate", "data_gap_investigation": "look", "unknown_data_response_guidance": "say so"}


@pytest.mark.parametrize(("response", "surface", "status"), [
    (advice(), "instructions.response", "needs_human_review"), ('{"value": null, "error": "x"}', "instructions.response", "ai_error"), ('{"value": {}, "error": 5}', "instructions.response", "invalid_output"),
    (advice(would_regress_good_behavior=True), "instructions.response", "suppressed"), (advice(recommendation_warranted=False, change_mode="none", citations=[]), "instructions.response", "suppressed"),
    (advice(recommendation_warranted=False), "instructions.response", "invalid_output"), (advice(citations=[]), "instructions.response", "invalid_output"),
    (advice(citations=[{"url": "https://d/2", "quote": "quote", "supports": "x"}]), "instructions.response", "invalid_output"), (advice(citations=[{"url": "https://d/1", "quote": "q", "supports": "x", "more": 1}]), "instructions.response", "invalid_output"),
    (advice(change_mode="replace", displaced_text="Be brief."), "instructions.response", "needs_human_review"), (advice(change_mode="replace", displaced_text="Be long."), "instructions.response", "invalid_output"),
    (advice(), "skills", "invalid_output"), (advice(change_mode="investigate"), "skills", "needs_human_review"), (advice(extra=1), "instructions.response", "invalid_output"), (advice(headline=" "), "instructions.response", "invalid_output"),
    (advice(**GAP), "data", "needs_human_review"), (advice(**GAP | {"unknown_data_response_guidance": "LOOK "}), "data", "invalid_output"), (advice(**GAP), "skills", "invalid_output"),
    (advice(**GAP, reasoning="mail a@b"), "data", "invalid_output"), (advice(**GAP, reasoning="it is Verified."), "data", "invalid_output"), (advice(reasoning="please drop table x"), "instructions.response", "invalid_output"),
    (advice(confidence="sure"), "instructions.response", "invalid_output"), (advice(reasoning=5), "instructions.response", "invalid_output"), (advice(citations="drop"), "instructions.response", "invalid_output"),
])
def test_recommendation_checks(spark, response, surface, status):
    inputs = spark.createDataFrame([("i", surface, surface == "data", "Be brief.", [("https://d/1", "t", "a quote here")])], "recommendation_id string, surface string, investigate_only boolean, target_instructions string, passages array<struct<url:string,title:string,chunk:string>>")
    replies = spark.createDataFrame([("i", AS_OF, response), ("i", BASE, advice(confidence="old"))], "recommendation_id string, generated_at timestamp_ntz, model_response string")
    got = recommend.recommendation_results(replies, inputs).collect()
    assert [r["review_status"] for r in got] == [status]


def test_queue_has_a_sentinel_and_the_digest_shows_it(spark):
    groups = spark.createDataFrame([], "group_id string, agent_database string, agent_schema string, agent_name string, surface string, total_occurrences long, total_good_responses long, eligibility_status string, documentation_status string, docs_captured_at timestamp_ntz")
    candidates = spark.createDataFrame([], "group_id string, recommendation_id string, is_within_budget boolean")
    results = spark.createDataFrame([], "recommendation_id string, review_status string, model_error string, validation_note string, headline string")
    queue = lambda ok: recommend.review_queue(groups, candidates, results, spark.createDataFrame([(ok,)], "ok boolean"))
    assert queue(True).count() == 0 and [r["queue_status"] for r in queue(False).collect()] == ["invalid_settings"]
    assert reports.digest(queue(True)).first()["preview_status"] == "empty_current_queue"
    assert reports.digest(queue(False)).first()["preview_status"] == "invalid_settings"


def test_duplicates(spark):
    t = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in reports.duplicate_report({"x": (t, "k"), "y": (t.distinct(), "k")}).collect()] == [("x", "a", 2)]


def test_runs_freeze_send_once_and_append(spark, pairs, one_config):
    s = settings.read_settings(settings_rows(spark, {}), AS_OF)
    none = spark.createDataFrame([], "review_id string, reviewed_at timestamp_ntz, model_response string")
    queue = lambda reviews: findings.review_candidates(pairs, one_config, reviews, s)
    columns = [c for c in queue(none).columns if c not in ("evidence", "feedback_time")]
    first = queue(none).select(columns)
    inputs = first.limit(0).withColumn("prepared_at", F.lit(AS_OF).cast("timestamp_ntz"))

    def scorer(prompt):
        if "Question 2." in prompt:
            raise ValueError("no")
        return reply_value

    reply_value = '{"assessment": "good"}'
    inputs, reviews = workflow.run_reviews(first, inputs, none, 20, AS_OF, scorer)
    assert (inputs.count(), reviews.count()) == (20, 20)
    assert reviews.where(F.col("model_response").contains('"error":"no"')).count() > 0
    inputs, reviews = workflow.run_reviews(queue(reviews).select(columns), inputs, reviews, 20, AS_OF, scorer)
    assert (inputs.count(), reviews.count(), queue(reviews).count()) == (28, 28, 0)
    assert workflow.run_reviews(first, inputs, reviews, 20, AS_OF, scorer)[1].count() == 28


def test_snapshots_get_ids_of_their_own(spark):
    specs = history(spark, ("A", "{}"), ("A", "{}")).drop("snapshot_id")
    assert spans.snapshot(specs).select("snapshot_id").distinct().count() == 2


@pytest.mark.parametrize("name", ["pair_hash", "evidence_groups", "good_counterevidence"])
def test_identities_of_groups_are_hashed_row_by_row(spark, name):
    from tracewise.plans.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(pair_hash" not in plan and "collect_list(sha2" not in plan


def test_json_of_any_depth(spark):
    deep = "[" * 500 + "]" * 500
    too_deep = "[" * 200_000 + "]" * 200_000
    rows = spark.createDataFrame([(1, deep), (2, too_deep), (3, None), (4, "{")], "i int, t string")
    got = {r["i"]: r["n"] for r in rows.select("i", F.size(canonical_nodes(F.col("t"))).alias("n")).collect()}
    assert got[1] == 500 and all(got[i] in (None, -1) for i in (2, 3, 4))


def test_text_rules_and_their_parameters(spark):
    rows = spark.createDataFrame([(t,) for t in ("then drop it", "raindrop it", "my_drop it", "```SQL x", "```duck x", "so Verified.", "unverified")], "t string")
    t = F.col("t")
    got = [tuple(r) for r in rows.select(recommend.says_word(t, ("DROP",), "A-Za-z_", r"\s"), recommend.shows_fence(t, ("sql",)), recommend.shows_fence(t, ("sql", "duck")), recommend.says_word(t, ("verified",), "A-Za-z")).collect()]
    assert got == [(True, False, False, False), (False,) * 4, (False,) * 4, (False, True, True, False), (False, False, True, False), (False, False, False, True), (False,) * 4]


def test_clusters_need_a_shared_folder(spark, monkeypatch):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError):
        scratch.scratch_dir(Cluster)


def test_conversations_of_any_number_lie_in_the_same_days(spark):
    rows = spark.range(0, 1_000_000, 9_999).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'hi' as text")
    at = adapters.conversation_events(rows).agg(F.min("event_time").cast("date").cast("string"), F.max("event_time").cast("date").cast("string")).first()
    assert at[0] >= "2024-01-01" and at[1] < "2024-04-01"


def test_traces_of_no_day_are_a_tenth_off(spark):
    """Two hundred days: with a standard deviation of 0.05 some were 300 of 2,000 off."""
    n, days = 2000, 200
    at = F.timestamp_add("DAY", (F.col("id") % days).cast("int"), F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    rows = spark.range(n * days).select(at.alias("ts"), F.to_json(F.struct(F.col("id").cast("string").alias("trace_id"))).alias("trace"))
    found = capture.stream_activity(rows).collect()
    assert len(found) == days and max(abs(r["traces"] - n) for r in found) <= n / 10


def test_only_newest_searches_are_parsed(spark, monkeypatch):
    """Groups and advice take passages of the newest search of each area; once every search was parsed for each of them."""
    from tracewise.plans.model import Model

    seen, plain = [], docs.doc_passages
    monkeypatch.setattr(docs, "doc_passages", lambda rows, prefix: seen.append(rows.count()) or plain(rows, prefix))
    m = Model(spark, "/root/testdata/sf0.001")
    m.advice_candidates.count()
    assert seen and max(seen) <= len(settings.AREAS) < m.retrievals.count()


def test_newest_searches_give_the_latest_of_all(spark):
    """Ties in time, ids in several areas, areas and ids that are null, and rows that are there twice."""
    ok, t = '{"results": [{"url": "https://x", "title": "t", "chunk": "c"}]}', datetime(2024, 3, 1)
    rows = [("r1", t, "a", "s", "q", ok), ("r2", t, "a", "s", "q", "[1]"), ("r2", t, "b", "s", "q", ok), ("r3", t + timedelta(1), "b", "s", "q", "{}"), ("r4", t, None, "s", None, ok),
            (None, t, "c", "s", "q", ok), ("r5", None, "d", "s", "q", ok), ("r6", t, "e", "s", "q", ok), ("r6", t, "e", "s", "q", ok)]
    all_ = spark.createDataFrame(rows, "retrieval_id string, captured_at timestamp_ntz, area_key string, service_name string, query_text string, response string")
    latest = lambda r: sorted(map(str, docs.doc_latest(docs.doc_status(r, docs.doc_passages(r, "https://")), docs.doc_passages(r, "https://")).collect()))
    assert latest(docs.newest(all_)) == latest(all_) and len(latest(all_)) == 6


def test_the_history_is_read_once(spark):
    """The snapshots of each agent are aggregated once; once they were for the texts to walk and again for the rows."""
    from pyspark.sql import types as T

    runs = spark.sparkContext.accumulator(0)

    @F.udf(T.StringType())
    def seen(x):
        runs.add(1)
        return x

    h = spark.createDataFrame([("d", "s", "a", f"i{i}", datetime(2024, 1, 1 + i), '{"k": 1}') for i in range(5)], f"{', '.join(f'{a} string' for a in AGENT)}, snapshot_id string, captured_at timestamp_ntz, specification string")
    rows = config.current_config(h.withColumn("specification", seen("specification"))).collect()
    assert [r["snapshot_id"] for r in rows] == ["i4"] and runs.value == 5
