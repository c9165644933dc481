"""The latest settings of each agent and their identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.hashing import AGENT
from tracewise.functions.variants import is_object, with_canonical_hash
from tracewise.sources.scratch import materialise


def current_config(history: DataFrame) -> DataFrame:
    """The last snapshot of each agent, with config_hash (null unless an object) and specification_is_valid.

    history: snapshot_id, captured_at, agent columns, specification (JSON text). Ranked before validity: a newer bad
    snapshot hides an older good one. One aggregation, run once; only the rows that it leaves are parsed.
    """
    last = history.groupBy(*AGENT).agg(F.max(F.struct("captured_at", "snapshot_id", "specification")).alias("last"))
    rows = materialise(last.select(*AGENT, "last.snapshot_id", "last.captured_at", "last.specification"), "last")
    rows = rows.withColumn("specification_is_valid", is_object(F.try_parse_json(F.col("specification"))))
    rows = with_canonical_hash(rows, "specification", "config_hash")
    return rows.withColumn("config_hash", F.when(F.col("specification_is_valid"), F.col("config_hash")))


def instructions(config: DataFrame) -> DataFrame:
    """Agent columns with the two instruction texts and the model, where they are strings."""
    from tracewise.functions.variants import string

    v = F.try_parse_json(F.col("specification"))
    return config.select(
        *AGENT, "snapshot_id", string(v, "$.instructions.response").alias("response_instructions"),
        string(v, "$.instructions.orchestration").alias("orchestration_instructions"), string(v, "$.models.orchestration").alias("orchestration_model"),
    )
