"""Saved tables, digests of groups, ranks and the search index: what they cost and that they lose nothing."""

import glob
import hashlib
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from tracewise.functions.hashing import leaf_digests, members_digest, root_digests, updated_leaves
from tracewise.operators import search, work
from tracewise.sources.runlog import RunLog
from tracewise.plans import queries
from tracewise.plans.model import Model
from tracewise.sources import saved, spans
from tracewise.sources.saved import SavedTable
from tracewise.sources.scratch import new_path


def rows_in(folder):
    import pyarrow.parquet as pq

    return sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{folder}/**/*.parquet", recursive=True))


# --- logs of runs


@pytest.fixture
def log(spark, tmp_path):
    return RunLog(spark, f"file://{tmp_path}/log", spark.createDataFrame([], "id long, text string").schema)


def test_a_run_writes_what_it_adds(spark, log, tmp_path):
    assert log.read().count() == 0 and log.runs() == {}
    assert log.append(spark.range(5000).selectExpr("id", "'x' as text"), "first")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/log/runs/**/*", recursive=True)}
    assert log.append(spark.range(5000, 5020).selectExpr("'y' as text", "id"), "second")
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/log/runs/**/*", recursive=True)}
    assert {k: after[k] for k in before} == before and rows_in(f"{tmp_path}/log") == 5020
    assert log.read().count() == 5020 and log.read("second").where("text = 'y'").count() == 20


def test_torn_and_replayed_runs_are_not_seen(spark, log, tmp_path):
    rows = spark.range(3).selectExpr("id", "'x' as text")
    log.append(rows, "a")
    log.write(rows, "b")  # half of a run: rows without a marker
    (tmp_path / "log/_commits/b").write_text("runs/b-of-a-driver-that-d")  # and a marker that was cut off
    assert log.read().count() == 3 and list(log.runs()) == ["a"]
    assert not log.append(rows.unionAll(rows), "a") and log.read().count() == 3
    assert log.append(rows, "b") and log.read().count() == 6
    folder = log.write(rows, "b")
    assert not log.publish("b", folder) and log.read().count() == 6
    for bad in ("", "a/b", "../x", "_x"):
        with pytest.raises(ValueError):
            log.append(rows, bad)


# --- bucketed tables with bitmaps


@pytest.fixture
def table(spark):
    return SavedTable(spark, new_path(spark, "saved"), spark.createDataFrame([], "id string, n long").schema, "id", buckets=4, slot_bits=20)


def keys(spark, start, end):
    return spark.range(start, end).selectExpr("sha2(string(id), 256) as id", "id as n")


def test_merges_add_each_key_once(spark, table):
    assert table.merge(keys(spark, 0, 500)).count() == 500
    assert table.merge(keys(spark, 0, 500)).count() == 0
    twice = keys(spark, 400, 700)
    assert sorted(r["n"] for r in table.merge(twice.unionAll(twice)).collect()) == list(range(500, 700))
    assert table.rows().count() == 700 == table.rows().select("id").distinct().count()
    assert table.merge(keys(spark, 0, 0)).count() == 0
    assert table.unsaved(keys(spark, 690, 705)).count() == 5 and table.rows().count() == 700


def test_only_suspects_are_looked_up_and_saved_rows_stay_in_their_buckets(spark, table):
    table.merge(keys(spark, 0, 2000))
    flagged = table.suspects(keys(spark, 1900, 12_000)).groupBy("_suspect").count().collect()
    counts = {r["_suspect"]: r["count"] for r in flagged}
    assert 100 <= counts[True] < 200 and counts[False] > 9900  # slots that others have taken: 2000 of a million
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        from tracewise.sources.saved import looked_up

        plan = looked_up(keys(spark, 0, 10), table.rows(), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    at = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    above = [line for line in plan.splitlines()[:at]]
    join = max(i for i, line in enumerate(above) if "ShuffledHashJoin" in line)
    assert not any("Exchange" in line for line in above[join + 1 :])


def test_no_bucket_of_the_captures_grows_with_the_table(spark, monkeypatch):
    """A thousand events in buckets of a hundred rows: with eight buckets, whatever the table, each held more."""
    monkeypatch.setattr(saved, "BUCKET_ROWS", 100)
    monkeypatch.setattr(saved, "LEAST_BUCKETS", 1)
    m = Model(spark, "/root/testdata/sf0.001")
    n = m.table("events").count()
    table = queries._saved_events(m, m.events.select("event_hash"))
    assert table.buckets == -(-n // 100) > 8
    table.merge(m.table("events").select(F.sha2(F.col("event_id").cast("string"), 256).alias("event_hash")))
    sizes = table.rows().groupBy(F.input_file_name()).count().collect()
    assert sum(r[1] for r in sizes) == n and max(r[1] for r in sizes) < 150


def test_a_key_that_a_text_lacks_is_not_parsed(spark):
    """Escaped, absent, repeated, nested and null keys and malformed texts, as get_json_object has them."""
    key = "agent.response"
    texts = ['{"agent.response": "a"}', '{"agent\\u002eresponse": "b"}', '{"x": "agent.response"}', '{"x": 1}', '{"agent.response": 1, "agent.response": 2}',
             '{"agent.response": {"b": 1.50}}', '{"agent.response": null}', '{"agent.response": "c"', "[1]", "", None, '{"other": {"agent.response": "d"}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    got = rows.select("i", spans.json_text("t", key).alias("got"), F.get_json_object("t", f"$['{key}']").alias("want"))
    found = {r["i"]: r["got"] for r in got.collect()}
    assert all(r["got"] == r["want"] for r in got.collect()) and found[0] == "a" and found[1] == "b" and found[3] is None
    assert "Contains(t" in got._jdf.queryExecution().optimizedPlan().toString()


def test_full_bitmaps_and_null_keys_lose_nothing(spark):
    schema = spark.createDataFrame([], "id string, n long").schema
    table = SavedTable(spark, new_path(spark, "saved"), schema, "id", buckets=2, slot_bits=15)
    table.merge(keys(spark, 0, 100_000))  # three keys a slot: all that come are suspects
    assert table.suspects(keys(spark, 200_000, 200_100)).where("_suspect").count() > 90
    assert table.merge(keys(spark, 99_950, 100_050)).count() == 50
    nulls = spark.createDataFrame([(None, 1), (None, 2)], schema)
    assert table.merge(nulls).count() == 1


# --- spans by day


def test_only_the_days_of_the_window_are_opened(spark, tmp_path):
    from datetime import datetime, timedelta

    from tracewise.operators.settings import Settings
    from tracewise.sources import spans

    start, path = datetime(2024, 1, 1), f"{tmp_path}/days"
    rows = [("SPAN", start + timedelta(hours=5 * i), f'{{"trace_id": "{i}"}}', "{}", "{}") for i in range(60)] + [("SPAN", None, "{}", "{}", "{}")]
    spans.write_daily(spark.createDataFrame(rows, spans.SPAN_SCHEMA), f"file://{path}")
    window = Settings(datetime(2024, 1, 3, 7), datetime(2024, 1, 5, 2), None, 1, 1, 1, 1, "v")
    for f in glob.glob(f"{path}/span_day=*/*.parquet"):
        day = f.split("span_day=")[1][:10]
        if not "2024-01-03" <= day <= "2024-01-05":
            os.remove(f)
            with open(f, "w") as out:
                out.write("no parquet at all")
    got = spans.read_daily(spark, f"file://{path}", window)
    want = [r[1] for r in rows if r[1] and window.review_start <= r[1] < window.review_end]
    assert sorted(r["ts"] for r in got.collect()) == want and got.columns == ["record_type", "ts", "trace", "record", "record_attributes"]
    assert spans.read_daily(spark, f"file://{path}", None).isEmpty()
    with pytest.raises(Exception, match="(?i)parquet"):
        spark.read.schema(spans.SPAN_SCHEMA).parquet(f"file://{path}").collect()


# --- digests of groups


def plain_digest(members, size=4):
    leaves = [f"{p}:{hashlib.sha256(','.join(g).encode()).hexdigest()}" for p, g in ((p, list(g)) for p, g in itertools.groupby(sorted(members), lambda m: m[:size]))]
    return hashlib.sha256(",".join(leaves).encode()).hexdigest()


def test_digests_of_groups_equal_plain_ones(spark):
    rows = [(g, hashlib.sha256(str(i % n).encode()).hexdigest()) for g, n in (("a", 300), ("b", 1)) for i in range(300)] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, m string")
    got = {r["g"]: (r["digest"], r["n"]) for r in members_digest(df, ["g"], "m").collect()}
    assert got == {g: (plain_digest([m for h, m in rows if h == g and m]), 300) for g in "ab"}
    assert members_digest(df.limit(0), ["g"], "m").count() == 0


def test_no_task_holds_a_group_and_appends_hash_their_leaves_only(spark):
    df = spark.range(100_000).selectExpr("'one' as g", "sha2(string(id), 256) as m").repartition(4)
    leaves = leaf_digests(df, ["g"], "m")
    assert leaves.agg(F.max("n")).first()[0] < 20 and leaves.count() > 50_000
    saved, new = df.where("m < 'fff8'"), df.where("m >= 'fff8'")
    old = leaf_digests(saved, ["g"], "m").cache()
    after = updated_leaves(old, saved, new, ["g"], "m")
    assert root_digests(after, ["g"]).collect() == root_digests(leaves, ["g"]).collect()
    assert after.join(old, ["g", "leaf", "digest"], "left_anti").count() <= 8


# --- ranks


def test_ranks_of_all_rows_without_a_window(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 5), i, "x") for i in range(5000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "t int, id int, row string")
    out = work.ranked(df, ["t", "id"], "rank")
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString() and out.columns == ["t", "id", "row", "rank"]
    got = sorted((r["rank"], r["t"], r["id"]) for r in out.collect())
    assert got == [(i + 1, t, k) for i, (t, k, _) in enumerate(sorted(rows))]
    assert work.ranked(df.limit(0), ["t", "id"], "rank").count() == 0


# --- search


def made_corpus(n, seed=1):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(400)]
    docs = [" ".join(rng.choice(common if rng.random() < 0.8 else rare) for _ in range(rng.randint(3, 60))) for _ in range(n)]
    queries = [(i, " ".join([*rng.sample(common, 6), *rng.sample(rare, 4)])) for i in range(10)]
    return list(enumerate(docs)), queries


def plain_search(docs, queries, k):
    import math
    import re

    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    terms = {d: split(t) for d, t in docs}
    mean = sum(map(len, terms.values())) / len(terms)
    df = {}
    for found in terms.values():
        for t in set(found):
            df[t] = df.get(t, 0) + 1
    out = []
    for q, text in queries:
        scores = []
        for d, found in terms.items():
            hits = [t for t in set(split(text)) if t in found]
            if hits:
                w = sum(math.log(1 + (len(terms) - df[t] + 0.5) / (df[t] + 0.5)) * (tf := found.count(t)) * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(found) / mean)) for t in hits)
                scores.append((-round(w, 6), d))
        out += [(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("slice_", [65_536, 40])
def test_search_equals_plain_scores_and_meets_few_pairs(spark, monkeypatch, slice_):
    monkeypatch.setattr(search, "SLICE", slice_)
    docs, queries = made_corpus(1500)
    corpus, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "query_id long, query_text string")
    index = search.build_index(corpus, "doc_id", "text")
    got = sorted((r["query_id"], r["rank"], r["doc"], r["score"]) for r in search.search(asked, index, 5).collect())
    want = plain_search(docs, queries, 5)
    assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, want, strict=True))
    met = search.survivors(search.bounded_terms(asked, index, 5), index)[0].count()
    every = search.asked_terms(asked).join(index.postings, "term").select("query_id", "doc").distinct().count()
    assert met < every / 5
    if slice_ == 40:
        assert index.blocks.where("term = 'c1'").select("slice").distinct().count() > 10  # a common term lies in many blocks


def test_search_of_odd_tables(spark):
    docs = [(1, "One two two"), (2, None), (3, ""), (4, "two ones"), (5, "ONE two two"), (6, "five")]
    corpus = spark.createDataFrame(docs, "doc_id long, text string")
    queries = [(1, "two, one!"), (2, "absent"), (3, None), (4, ""), (5, "two two")]
    asked = spark.createDataFrame(queries, "query_id long, query_text string")
    got = sorted(map(tuple, search.search_passages(asked, corpus, 5).select("query_id", "rank", "doc_id", "score").collect()))
    assert got == plain_search(docs, queries, 5) and [g[2] for g in got if g[0] == 1] == [1, 5, 4]
    assert search.search_passages(asked.limit(0), corpus).count() == 0 and search.search_passages(asked, corpus.limit(0)).count() == 0
