"""Threads of any size: numbers, neighbours and context without a task that holds a thread."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_workflow import event, saved
from tracewise.operators import turns


def thread_events(n):
    """One thread of n turns, some of them incomplete, beside small threads and turns without one."""
    rows = [event("A", i, f"t{i:05}", thread="core", q=None if i % 7 == 3 else f"Q{i}?", a=f"A{i}.") for i in range(n)]
    rows += [event("A", i, f"s{i:05}", thread=f"s{i % 9}", q="Q?", a="A.") for i in range(60)]
    return rows + [event("A", i % 3, f"u{i:05}", thread=None, q="Q?", a="A.") for i in range(n // 2)]


def test_numbers_of_a_large_group_come_from_many_ranges(spark, monkeypatch):
    df = spark.createDataFrame([("x" if i % 2 else None if i % 3 else f"y{i}", i * 7919 % 10_007, i) for i in range(8000)], "g string, t long, at long")
    written, materialise = [], turns.materialise
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which puts a few rows together
    monkeypatch.setattr(turns, "materialise", lambda rows, name: written.append(materialise(rows, name)) or written[-1])
    try:
        out = turns.numbered(df.withColumnRenamed("at", "id"), ["g"], ["t"], "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = df.withColumnRenamed("at", "id").withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("t")).cast("long"))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    sizes = [r["count"] for r in written[0].groupBy(F.shiftright("at", 33)).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 3000  # half of the rows are one group
    assert written[0].where("g = 'x'").select(F.shiftright("at", 33)).distinct().count() >= 2
    assert turns.numbered(df.limit(0), ["g"], ["t"], "n").count() == 0


@pytest.mark.parametrize("block", [6, 50])
def test_pairs_and_context_over_borders_of_blocks(spark, monkeypatch, block):
    events = saved(spark, thread_events(400))
    found = turns.conversation_turns(events).cache()
    assert [r["turn_no"] for r in found.where("thread_id = 'core'").orderBy("trace_id").collect()] == list(range(1, 401))
    assert sorted(r["turn_no"] for r in found.where("thread_id is null").collect()) == list(range(1, 201))
    whole = turns.answer_followup_pairs(found)
    want = {(r["feedback_trace_id"], r["pair_hash"]) for r in whole.collect()}
    monkeypatch.setattr(turns, "BLOCK", block)
    cut = turns.answer_followup_pairs(found)
    got = [(r["feedback_trace_id"], r["pair_hash"]) for r in cut.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 250
    sizes = found.where("thread_id is not null").groupBy("thread_id", F.expr(f"(turn_no - 1) div {block}")).count().agg(F.max("count")).first()[0]
    assert sizes <= block
    last = next(r for r in cut.collect() if r["feedback_trace_id"] == "t00399")
    assert [t["trace_id"] for t in last["evidence"]["prior_turns"]] == ["t00393", "t00394", "t00396", "t00397", "t00398"]


def test_settings_numbers_of_empty_tables(spark):
    from tracewise.operators import settings

    areas = spark.createDataFrame([], "area_key string, area_description string, documentation_query string")
    row = settings.settings_numbers(spark.createDataFrame([], settings.SETTINGS_SCHEMA), areas).collect()
    assert len(row) == 1 and (row[0]["settings_rows"], row[0]["rows_keyed_one"], row[0]["unusable_thread_filters"], row[0]["area_rows"]) == (0, 0, 0, 0)
    two = spark.createDataFrame([(1, None, None, " 0 ", 5, 6, 7, 8, " v "), (1, None, None, None, 3, 9, None, 2, ""), (2, None, None, "\t", 4, 9, 9, 9, None)], settings.SETTINGS_SCHEMA)
    r = settings.settings_numbers(two, areas).first()
    assert (r["settings_rows"], r["rows_keyed_one"], r["unusable_thread_filters"], r["max_new_reviews"], r["min_occurrences"], r["prompt_revision_length"]) == (3, 1, 2, 3, 7, 0)
