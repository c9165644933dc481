"""The two scoring steps from queue to saved replies: freeze a batch, save its inputs, freeze what is to be sent, send, save."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.operators import work
from tracewise.operators.settings import now
from tracewise.sources.runlog import RunLog
from tracewise.sources.scratch import new_path

#: Which of several saved inputs of an id is sent: the first by these.
INPUT_ORDER = ["prepared_at", "prompt_hash", "prompt_text"]


def inference_batch(batch: DataFrame, inputs: DataFrame, replies: DataFrame, key: str, same: list[str], ready: DataFrame | None = None) -> DataFrame:
    """One saved input for each id of the batch that has no reply; `same` columns must agree, `ready` ids only if given."""
    on = [key, *same]
    rows = inputs.join(batch.select(*on).distinct(), on, "left_semi")
    rows = rows if ready is None else rows.join(ready.select(key), key, "left_semi")
    return work.latest_input(work.not_saved(rows, replies, key), key, INPUT_ORDER)


def run(candidates: DataFrame, inputs: DataFrame, replies: DataFrame, key: str, order: list[str], cap: int, same: list[str], as_of: datetime, scorer: Callable[[str], str], ready: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(inputs, replies) after one run over the first `cap` candidates: the given tables, which are not written again, and
    what the run adds.

    The batch is frozen before its inputs are saved, and what is sent is the saved text. A second run over the same
    tables sends nothing that has a reply, errors included. `ready` is asked of the saved inputs just before sending.
    """
    spark = candidates.sparkSession
    save = lambda rows, name, old: old.unionByName(work.freeze(rows, new_path(spark, name)))
    batch = work.freeze(candidates.orderBy(*order).limit(cap), new_path(spark, "batch"))
    inputs = save(_prepared(batch, inputs, key, as_of), "inputs", inputs)
    return inputs, save(_scored(batch, inputs, replies, key, same, as_of, scorer, ready), "replies", replies)


def run_logged(name: str, candidates: DataFrame, inputs: RunLog, replies: RunLog, key: str, order: list[str], cap: int, same: list[str], as_of: datetime, scorer: Callable[[str], str], ready: Callable[[DataFrame], DataFrame] | None = None) -> bool:
    """As run, over logs, to which it adds its inputs and its replies as the run `name`; False if that run is saved already.

    A run that ended before its replies were published, and is called again, sends the inputs that it has published first;
    only these and other saved inputs are sent then, and no input is added.
    """
    if name in replies.runs():
        return False
    own = inputs.read(name).select(key).withColumn("is_own", F.lit(True))
    first = candidates.join(own, key, "left").orderBy(F.col("is_own").isNull(), *order).limit(cap).drop("is_own")
    batch = work.freeze(first, new_path(candidates.sparkSession, "batch"))
    inputs.append(_prepared(batch, inputs.read(), key, as_of), name)
    return replies.append(_scored(batch, inputs.read(), replies.read(), key, same, as_of, scorer, ready), name)


def _prepared(batch: DataFrame, inputs: DataFrame, key: str, as_of: datetime) -> DataFrame:
    """The batch's inputs that are not saved yet, one for each id."""
    rows = batch.withColumn("prepared_at", now(as_of)).select(*inputs.columns)
    return work.not_saved(rows, inputs, key).dropDuplicates([key])


def _scored(batch: DataFrame, inputs: DataFrame, replies: DataFrame, key: str, same: list[str], as_of: datetime, scorer: Callable[[str], str], ready: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The replies to the batch's saved inputs that have none; what is sent is frozen first."""
    send = work.freeze(inference_batch(batch, inputs, replies, key, same, ready(inputs) if ready else None), new_path(batch.sparkSession, "send"))
    scored = work.envelopes(work.score_rows(send, key, "prompt_text", scorer), key)
    stamp = next(c for c in replies.columns if c not in (key, "model_response"))
    return work.not_saved(scored.withColumn(stamp, now(as_of)).select(*replies.columns), replies, key).dropDuplicates([key])


def run_reviews(candidates: DataFrame, inputs: DataFrame, reviews: DataFrame, cap: int, as_of: datetime, scorer: Callable[[str], str]) -> tuple[DataFrame, DataFrame]:
    return run(candidates, inputs, reviews, "review_id", ["feedback_time_utc", "review_id"], cap, ["agent_database", "agent_schema", "agent_name"], as_of, scorer)


def run_recommendations(candidates: DataFrame, inputs: DataFrame, advice: DataFrame, as_of: datetime, scorer: Callable[[str], str], ready: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """As run_reviews, over candidates within the budget; readiness is checked again on the saved inputs."""
    allowed = candidates.where("is_within_budget")
    return run(allowed, inputs, advice, "recommendation_id", ["first_feedback_utc", "recommendation_id"], 20, ["config_hash", "instruction_template_hash", "sample_policy"], as_of, scorer, ready)


def counts(rows: DataFrame) -> DataFrame:
    """One row: candidates, reused results, calls in the budget, and what is deferred."""
    return rows.agg(
        F.count("*").alias("eligible_groups"), F.count_if("has_saved_result").alias("reused_results"), F.count_if("is_within_budget").alias("new_calls_in_budget"),
        F.count_if(~F.col("has_saved_result") & ~F.col("is_within_budget")).alias("deferred_now"),
    )
