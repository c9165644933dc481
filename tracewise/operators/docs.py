"""Saved documentation searches: accepted passages, status, the latest exact search, readiness."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.hashing import NO_ITEMS, identity, list_identity
from tracewise.functions.text import accepted_url, not_blank
from tracewise.functions.variants import absent, at, is_array, is_object, items, string
from tracewise.operators.settings import Settings, now

SEARCH = ("retrieval_id", "captured_at", "area_key", "service_name", "query_text")


def doc_passages(retrievals: DataFrame, prefix: str) -> DataFrame:
    """Accepted results of responses without an error: typed url, title and chunk, with position and passage_id.

    retrievals: SEARCH columns and response (JSON text). The texts stay byte for byte as they are.
    """
    v = F.try_parse_json(F.col("response"))
    ok = is_object(F.col("v")) & is_array(at(F.col("v"), "$.results")) & absent(F.col("v"), "$.error")
    rows = retrievals.withColumn("v", v).where(ok).select(*SEARCH, F.posexplode(items(F.col("v"), "$.results")).alias("passage_index", "item"))
    rows = rows.withColumn("i", F.try_parse_json(F.col("item"))).where(is_object(F.col("i")))
    rows = rows.select(*SEARCH, "passage_index", *(string(F.col("i"), f"$.{c}").alias(c) for c in ("url", "title", "chunk")))
    good = accepted_url(F.col("url"), prefix) & not_blank(F.col("title")) & not_blank(F.col("chunk"))
    return rows.where(good).withColumn("passage_id", identity("url", "title", "chunk"))


def doc_status(retrievals: DataFrame, passages: DataFrame) -> DataFrame:
    """Every saved search with its counts and status: error, malformed, empty, rejected or ready, in this order."""
    v = F.try_parse_json(F.col("response"))
    accepted = passages.groupBy("retrieval_id").agg(F.count("*").alias("accepted_count"))
    rows = retrievals.withColumn("v", v).select(
        *SEARCH, (~(is_object(F.col("v")) & is_array(at(F.col("v"), "$.results")))).alias("malformed_envelope"),
        (is_object(F.col("v")) & ~absent(F.col("v"), "$.error")).alias("has_error"), F.size(items(F.col("v"), "$.results")).cast("long").alias("result_count"),
    )
    rows = rows.join(accepted, "retrieval_id", "left").withColumn("accepted_count", F.coalesce("accepted_count", F.lit(0).cast("long")))
    status = (
        F.when(F.col("has_error"), "error").when(F.col("malformed_envelope"), "malformed").when(F.col("result_count") == 0, "empty")
        .when(F.col("accepted_count") == 0, "rejected").otherwise("ready")
    )
    return rows.withColumn("rejected_count", F.col("result_count") - F.col("accepted_count")).withColumn("documentation_status", status)


def newest(retrievals: DataFrame) -> DataFrame:
    """The newest search of each exact area, service and query, and any other rows of their ids. Responses are not looked at,
    so what follows parses these alone; `doc_latest` of them is that of all."""
    last = retrievals.groupBy("area_key", "service_name", "query_text").agg(F.max(F.struct("captured_at", "retrieval_id")).alias("r"))
    ids = last.select(F.col("r.retrieval_id").alias("_id")).distinct()
    return retrievals.join(ids, F.col("retrieval_id").eqNullSafe(F.col("_id")), "left_semi")


def doc_latest(status: DataFrame, passages: DataFrame) -> DataFrame:
    """The newest search of each exact area, service and query, good or not, with the identity of its passages."""
    names = [c for c in status.columns if c not in ("area_key", "service_name", "query_text", "captured_at", "retrieval_id")]
    last = status.groupBy("area_key", "service_name", "query_text").agg(F.max(F.struct("captured_at", "retrieval_id", *names)).alias("r"))
    last = last.select("area_key", "service_name", "query_text", "r.*")
    hashes = (
        passages.select("retrieval_id", "passage_id").join(last.select("retrieval_id"), "retrieval_id", "left_semi")
        .groupBy("retrieval_id").agg(list_identity(F.array_sort(F.collect_list("passage_id"))).alias("content_hash"))
    )
    return last.join(hashes, "retrieval_id", "left").withColumn("content_hash", F.coalesce("content_hash", F.lit(NO_ITEMS)))


def doc_alignment(areas: DataFrame, latest: DataFrame, service: str) -> DataFrame:
    """Areas against saved searches of the service, both ways."""
    l = latest.where(F.col("service_name") == service).select(F.col("area_key").alias("k"), "query_text", "retrieval_id")  # noqa: E741
    rows = areas.select("area_key", "documentation_query").join(l, F.col("area_key") == F.col("k"), "full")
    state = (
        F.when(F.col("area_key").isNull(), "area_not_configured").when(F.col("retrieval_id").isNull(), "not_retrieved")
        .when(F.col("documentation_query") != F.col("query_text"), "query_mismatch").otherwise("query_matches")
    )
    return rows.select(F.coalesce("area_key", "k").alias("area_key"), "documentation_query", F.col("query_text").alias("saved_query_text"), "retrieval_id", state.alias("query_alignment"))


def doc_readiness(areas: DataFrame, latest: DataFrame, settings: Settings | None, service: str, as_of: datetime) -> DataFrame:
    """Each area's newest exact search and whether it can feed a recommendation."""
    on = (F.col("a.area_key") == F.col("d.area_key")) & (F.col("a.documentation_query") == F.col("d.query_text"))
    rows = areas.alias("a").join(latest.where(F.col("service_name") == service).alias("d"), on, "left")
    state = F.lit("invalid_settings")
    if settings is not None:
        oldest = now(as_of) - F.expr(f"interval {settings.docs_max_age_hours} hours")
        state = (
            F.when(F.col("retrieval_id").isNull(), "missing_exact_search").when(F.col("documentation_status") != "ready", F.col("documentation_status"))
            .when(F.col("captured_at") > now(as_of), "future_capture").when(F.col("captured_at") < oldest, "stale").otherwise("ready_for_suggestion_input")
        )
    return rows.select(
        "a.area_key", "documentation_query", "retrieval_id", "captured_at", "documentation_status", "accepted_count", "rejected_count", "content_hash",
        state.alias("input_status"),
    )


def responses(found: DataFrame, queries: DataFrame, corpus: DataFrame, captured_at: datetime, service: str, key: str = "doc_id") -> DataFrame:
    """Rows to append to the saved searches: one for each query (area_key, query_id, query_text), results in rank order."""
    hits = found.join(corpus.select(key, "url", "title", "chunk"), key).groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.struct("url", "title", "chunk").alias("r")))).alias("hits")
    )
    results = F.coalesce(F.transform("hits", lambda h: h.r), F.array().cast("array<struct<url:string,title:string,chunk:string>>"))
    return queries.join(hits, "query_id", "left").select(
        F.uuid().alias("retrieval_id"), now(captured_at).alias("captured_at"), "area_key", F.lit(service).alias("service_name"), "query_text",
        F.to_json(F.struct(results.alias("results"))).alias("response"),
    )
