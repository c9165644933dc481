"""Selecting a bounded batch of new work, freezing it, scoring it row by row and appending what came back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.sources.scratch import materialise


def not_saved(rows: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no saved row yet."""
    return rows.join(saved.select(key), key, "left_anti")


def batch(rows: DataFrame, order: list[str], cap: int, rank: str) -> DataFrame:
    """The first `cap` rows and their ranks. With a literal cap each task keeps its first rows only."""
    from pyspark.sql import Window

    first = rows.orderBy(*order).limit(cap)
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def ranked(rows: DataFrame, order: list[str], rank: str) -> DataFrame:
    """All rows with their rank (from 1) by `order`, in which no two rows may be equal; no window holds them.

    Rows are dealt out by ranges of the order and numbered within their range, which is written once, as another run of it
    could cut ranges elsewhere; a rank is the number in the range and the sizes of the ranges before. Only these sizes, one
    for each range, reach the driver. Columns, of any name but `rank`, are kept; no rows give none.
    """
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(sorted_.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "ranges")
    in_range = 33  # bits of the number within a partition
    sizes = placed.groupBy(F.shiftright("at", in_range).alias("range")).agg(F.count("*").alias("n")).orderBy("range").collect()
    before = dict(zip((r["range"] for r in sizes), accumulate((r["n"] for r in sizes), initial=0)))
    offset = rows.sparkSession.createDataFrame(list(before.items()), "range long, before long")
    numbered = placed.withColumn("range", F.shiftright("at", in_range)).join(F.broadcast(offset), "range")
    number = F.col("before") + F.col("at").bitwiseAND((1 << in_range) - 1) + 1
    return numbered.select(*(F.col("row")[c].alias(c) for c in rows.columns if c != rank), number.alias(rank))


def freeze(rows: DataFrame, path: str) -> DataFrame:
    """rows written once and read again, so that no later action draws ids, times or scores anew."""
    rows.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def latest_input(inputs: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One saved input for each key, the first by `order`."""
    names = [c for c in inputs.columns if c != key]
    return inputs.groupBy(key).agg(F.min(F.struct(*order, *(c for c in names if c not in order))).alias("r")).select(key, "r.*")


def score_rows(rows: DataFrame, key: str, prompt: str, scorer: Callable[[str], str]) -> DataFrame:
    """(key, value, error): the scorer's reply to each prompt as a text; what it raises is kept as the row's error.

    A call a row; a retried task calls again, so replies are appended by key and never twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            replies, errors = [], []
            for text in b[prompt]:
                try:
                    replies.append(scorer(text))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  an error is a result here
                    replies.append(None)
                    errors.append(str(e))
            yield pd.DataFrame({key: b[key], "value": replies, "error": errors})

    return rows.select(key, prompt).mapInPandas(run, f"{key} string, value string, error string")


def envelopes(scored: DataFrame, key: str) -> DataFrame:
    """(key, model_response): {"value": ..., "error": ...} as JSON text, one of both null."""
    value, error = F.coalesce("value", F.lit("null")), F.to_json(F.array("error"), {"ignoreNullFields": "false"})
    plain = F.when(F.col("error").isNull(), "null").otherwise(F.substr(error, F.lit(2), F.char_length(error) - 2))
    return scored.select(key, F.concat(F.lit('{"value":'), value, F.lit(',"error":'), plain, F.lit("}")).alias("model_response"))


def append_new(rows: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """The table after an insert by name of the rows whose key it lacks."""
    return saved.unionByName(not_saved(rows, saved, key).dropDuplicates([key]))
