"""The model tables of one input folder, each derived from the given tables on demand."""

from __future__ import annotations

import json
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.operators import config, docs, findings, recommend, settings, turns, work
from tracewise.sources import adapters
from tracewise.sources.scratch import materialise

AS_OF = datetime(2024, 4, 1, 2)
WINDOW = (datetime(2024, 1, 1), datetime(2024, 3, 15))
URL_PREFIX = "https://"
SERVICE = "search"
SURFACES = settings.AREAS[:7]


def review_scorer(prompt: str) -> str:
    """A stand-in for a model: the reply follows from the review's id. Some calls fail, some replies break the contract."""
    p = json.loads(prompt)
    h, s = p["id"][0], int(p["id"][1], 16)
    if h == "0":
        raise ValueError("timeout")
    poor, gap = h in "6789ab", h in "def"
    return json.dumps({
        "assessment": "bad" if h == "1" else "good" if h in "2345" else "poor" if poor else "unclear",
        "issue_type": "agent_behavior" if poor else "reported_data_gap" if gap else "none",
        "severity": "severe" if s < 4 else "moderate", "surface": SURFACES[s % 7] if poor else "data" if gap else "none",
        "observation": "seen", "evidence_quote": "no such quote" if h == "2" else p["q"][:20], "suspected_cause": "unknown", "preserve_behavior": "none",
    })


def advice_scorer(prompt: str) -> str:
    """As review_scorer, for recommendations."""
    p = json.loads(prompt)
    h, gap = p["id"][0], p["gap"]
    if h in "01":
        raise ValueError("timeout")
    warranted = h not in "23"
    cited = [{"url": p["url"], "quote": "no such quote" if h == "4" else p["quote"], "supports": "the change"}] if warranted else []
    return json.dumps({
        "recommendation_warranted": warranted, "headline": f"Advice <{p['id'][:6]}>", "reasoning": "seen", "suggested_change": "look again",
        "change_mode": "investigate" if warranted else "none", "displaced_text": "", "preserve_behavior": "all else",
        "would_regress_good_behavior": h == "5", "confidence": "low", "data_gap_investigation": "look" if gap and warranted else "",
        "unknown_data_response_guidance": "say so" if gap and warranted else "", "citations": cited,
    })


class Model:
    """Lazily built DataFrames; the settings row is the only thing that the driver reads. What the workflow saves, and what
    several later steps read, is written once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def settings_rows(self) -> DataFrame:
        return self.spark.createDataFrame([(1, *WINDOW, None, 20, 5, 2, 168, " v1 ")], settings.SETTINGS_SCHEMA)

    @cached_property
    def settings(self) -> settings.Settings | None:
        return settings.read_settings(self.settings_rows, AS_OF)

    @cached_property
    def areas(self) -> DataFrame:
        rows = [(a, f"what {a} holds", "drifted" if a == "skills" else f"about {a}") for a in settings.AREAS]
        return self.spark.createDataFrame(rows, "area_key string, area_description string, documentation_query string")

    @cached_property
    def events(self) -> DataFrame:
        return adapters.conversation_events(self.table("conversations"))

    @cached_property
    def turns(self) -> DataFrame:
        return turns.conversation_turns(self.events)

    @cached_property
    def pairs(self) -> DataFrame:
        return materialise(turns.answer_followup_pairs(self.turns), "pairs")

    @cached_property
    def history(self) -> DataFrame:
        return adapters.settings_history(self.table("events"))

    @cached_property
    def config(self) -> DataFrame:
        return materialise(config.current_config(self.history), "config")

    @cached_property
    def all_candidates(self) -> DataFrame:
        none = self.spark.createDataFrame([], "review_id string")
        return materialise(findings.review_candidates(self.pairs, self.config, none, self.settings), "candidates")

    @cached_property
    def review_inputs(self) -> DataFrame:
        """Prepared inputs: most candidates, by a digit of the id."""
        return self.all_candidates.where("substr(review_id, 3, 1) not in ('0', '1')")

    @cached_property
    def reviews(self) -> DataFrame:
        """Replies to most inputs."""
        rows = self.review_inputs.where("substr(review_id, 4, 1) <> '0'").select(
            "review_id", "feedback_time_utc", F.to_json(F.struct(F.col("review_id").alias("id"), F.col("user_question").alias("q"))).alias("prompt")
        )
        replies = work.envelopes(work.score_rows(rows, "review_id", "prompt", review_scorer), "review_id")
        times = rows.select("review_id", (F.col("feedback_time_utc") + F.expr("interval 1 day")).alias("reviewed_at"))
        return materialise(times.join(replies, "review_id"), "reviews")

    @cached_property
    def candidates(self) -> DataFrame:
        return work.not_saved(self.all_candidates, self.reviews, "review_id")

    @cached_property
    def findings(self) -> DataFrame:
        return findings.review_findings(self.reviews, self.review_inputs)

    @cached_property
    def retrievals(self) -> DataFrame:
        return adapters.page_retrievals(self.table("pages"))

    @cached_property
    def passages(self) -> DataFrame:
        return docs.doc_passages(self.retrievals, URL_PREFIX)

    @cached_property
    def doc_status(self) -> DataFrame:
        return docs.doc_status(self.retrievals, self.passages)

    @cached_property
    def newest(self) -> DataFrame:
        """Written, so that no step above parses the response of another search."""
        return materialise(docs.newest(self.retrievals), "newest")

    @cached_property
    def newest_passages(self) -> DataFrame:
        return docs.doc_passages(self.newest, URL_PREFIX)

    @cached_property
    def doc_latest(self) -> DataFrame:
        return docs.doc_latest(docs.doc_status(self.newest, self.newest_passages), self.newest_passages)

    @cached_property
    def observations(self) -> DataFrame:
        return materialise(recommend.observations(self.findings, self.reviews, self.pairs, self.config, self.settings), "observations")

    @cached_property
    def groups(self) -> DataFrame:
        groups = recommend.recommendation_groups(self.observations, self.config, self.areas, self.doc_latest, self.settings, True, SERVICE, AS_OF)
        return materialise(groups, "groups")

    @cached_property
    def all_advice(self) -> DataFrame:
        none = self.spark.createDataFrame([], "recommendation_id string")
        return materialise(recommend.recommendation_candidates(self.groups, self.newest_passages, none, self.settings), "advice-inputs")

    @cached_property
    def advice_inputs(self) -> DataFrame:
        return self.all_advice.where("substr(recommendation_id, 2, 1) not in ('0', '1')")

    @cached_property
    def advice(self) -> DataFrame:
        first = F.element_at("passages", 1)
        rows = self.advice_inputs.where("substr(recommendation_id, 2, 1) not in ('2', '3')").select(
            "recommendation_id", F.to_json(F.struct(F.col("recommendation_id").alias("id"), F.col("investigate_only").alias("gap"), first.url.alias("url"), F.left(first.chunk, F.lit(10)).alias("quote"))).alias("prompt")
        )
        replies = work.envelopes(work.score_rows(rows, "recommendation_id", "prompt", advice_scorer), "recommendation_id")
        return materialise(replies.withColumn("generated_at", settings.now(AS_OF)), "advice")

    @cached_property
    def advice_candidates(self) -> DataFrame:
        return recommend.recommendation_candidates(self.groups, self.newest_passages, self.advice, self.settings)

    @cached_property
    def results(self) -> DataFrame:
        return recommend.recommendation_results(self.advice, self.advice_inputs)

    @cached_property
    def settings_ok(self) -> DataFrame:
        s = settings.settings_status(self.settings_rows, AS_OF).select("settings_are_valid")
        return s.crossJoin(settings.areas_status(self.areas).select("areas_are_valid")).select((F.col("settings_are_valid") & F.col("areas_are_valid")).alias("ok"))

    @cached_property
    def queue(self) -> DataFrame:
        return recommend.review_queue(self.groups, self.advice_candidates, self.results, self.settings_ok)
