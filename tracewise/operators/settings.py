"""Settings and areas: row checks, the singleton guard, reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.functions.text import not_blank, trimmed

#: The areas that findings and recommendations name.
AREAS = (
    "instructions.response", "instructions.orchestration", "tool_description", "models.orchestration",
    "semantic_view", "verified_query", "skills", "data",
)
SETTINGS_SCHEMA = (
    "settings_id int, review_start timestamp_ntz, review_end timestamp_ntz, thread_filter string, max_new_reviews int,"
    " max_new_recommendations int, min_occurrences int, docs_max_age_hours int, prompt_revision string"
)
VALID = "valid"
INVALID = "invalid: one row keyed 1 with usable window, filter, limits and revision is required"


@dataclass(frozen=True)
class Settings:
    """The one valid settings row, read on the driver so that its bounds reach the scans as literals."""

    review_start: datetime
    review_end: datetime
    thread_filter: str | None
    max_new_reviews: int
    max_new_recommendations: int
    min_occurrences: int
    docs_max_age_hours: int
    prompt_revision: str


def now(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def checks(as_of: datetime) -> dict[str, Column]:
    """Name -> row condition; null counts as failed."""
    end, start = F.col("review_end"), F.col("review_start")
    filter_ = trimmed(F.col("thread_filter"))
    return {
        "keyed_one": F.col("settings_id") == 1,
        "window_runs_forward": start < end,
        "window_end_settled": end <= now(as_of) - F.expr("interval 15 minutes"),
        "window_span_sensible": end <= start + F.expr("interval 90 days"),
        "thread_filter_usable": F.col("thread_filter").isNull() | ~filter_.isin("", "0"),
        "reviews_cap_sensible": F.col("max_new_reviews").between(1, 100),
        "recommendations_cap_sensible": F.col("max_new_recommendations").between(1, 20),
        "occurrences_sensible": F.col("min_occurrences").between(1, 1000),
        "docs_age_sensible": F.col("docs_max_age_hours").between(1, 720),
        "prompt_revision_present": not_blank(F.col("prompt_revision")),
    }


def checked_settings(settings: DataFrame, as_of: datetime) -> DataFrame:
    """settings with a boolean for each check and row_is_valid."""
    found = {k: F.coalesce(c, F.lit(False)) for k, c in checks(as_of).items()}
    out = settings.withColumns(found)
    valid = F.lit(True)
    for k in found:
        valid = valid & F.col(k)
    return out.withColumn("row_is_valid", valid)


def settings_status(settings: DataFrame, as_of: datetime) -> DataFrame:
    """One row, even of an empty table: settings_rows, invalid_settings_rows, settings_are_valid, settings_status."""
    counted = checked_settings(settings, as_of).agg(
        F.count("*").alias("settings_rows"), F.count_if(~F.col("row_is_valid")).alias("invalid_settings_rows")
    )
    ok = (F.col("settings_rows") == 1) & (F.col("invalid_settings_rows") == 0)
    return counted.withColumn("settings_are_valid", ok).withColumn("settings_status", F.when(ok, VALID).otherwise(INVALID))


def read_settings(settings: DataFrame, as_of: datetime) -> Settings | None:
    """None unless there is one row and it is valid. At most two rows reach the driver."""
    rows = checked_settings(settings, as_of).take(2)
    if len(rows) != 1 or not rows[0]["row_is_valid"]:
        return None
    r = rows[0]
    filter_ = None if r["thread_filter"] is None else r["thread_filter"].strip(" \t\r\n")
    return Settings(
        r["review_start"], r["review_end"], filter_, r["max_new_reviews"], r["max_new_recommendations"],
        r["min_occurrences"], r["docs_max_age_hours"], r["prompt_revision"],
    )


def areas_status(areas: DataFrame) -> DataFrame:
    """One row: area_rows, unique_areas, valid_rows, areas_are_valid."""
    good = F.col("area_key").isin(*AREAS) & not_blank(F.col("area_description")) & not_blank(F.col("documentation_query"))
    out = areas.agg(
        F.count("*").alias("area_rows"), F.count_distinct("area_key").alias("unique_areas"), F.count_if(F.coalesce(good, F.lit(False))).alias("valid_rows")
    )
    n = len(AREAS)
    return out.withColumn("areas_are_valid", (F.col("area_rows") == n) & (F.col("unique_areas") == n) & (F.col("valid_rows") == n))


def settings_numbers(settings: DataFrame, areas: DataFrame) -> DataFrame:
    """One row, even of empty tables, with what the checks look at: numbers of rows, of distinct settings keyed 1 and of
    unusable thread filters, the smallest value of each limit, and the areas' distinct, expected and shortest texts."""
    length = lambda c: F.char_length(trimmed(F.col(c)))
    s = settings.agg(
        F.count("*").alias("settings_rows"), F.count_distinct(F.when(F.col("settings_id") == 1, F.col("settings_id"))).alias("rows_keyed_one"),
        *(F.min(c).alias(c) for c in ("review_start", "review_end", "max_new_reviews", "max_new_recommendations", "min_occurrences", "docs_max_age_hours")),
        F.min(length("prompt_revision")).cast("long").alias("prompt_revision_length"), F.count_if(trimmed(F.col("thread_filter")).isin("", "0")).alias("unusable_thread_filters"),
    )
    a = areas.agg(
        F.count("*").alias("area_rows"), F.count_distinct("area_key").alias("distinct_area_keys"),
        F.count_distinct(F.when(F.col("area_key").isin(*AREAS), F.col("area_key"))).alias("expected_area_keys_present"),
        F.min(length("area_description")).cast("long").alias("shortest_area_description"), F.min(length("documentation_query")).cast("long").alias("shortest_documentation_query"),
    )
    return s.crossJoin(F.broadcast(a))


def settings_report(settings: DataFrame, areas: DataFrame, as_of: datetime) -> DataFrame:
    """One row with the numbers of rows, the earliest window, and whether every row passes each named check."""
    names = list(checks(as_of))
    s = checked_settings(settings, as_of).agg(
        F.count("*").alias("settings_rows"), F.min("review_start").alias("review_start"), F.min("review_end").alias("review_end"),
        *(F.coalesce(F.bool_and(k), F.lit(False)).alias(k) for k in names),
    )
    a = areas_status(areas).select("area_rows", F.col("areas_are_valid").alias("areas_complete"))
    out = s.crossJoin(F.broadcast(a)).withColumn("one_settings_row_keyed_one", (F.col("settings_rows") == 1) & F.col("keyed_one")).drop("keyed_one")
    ready = F.col("one_settings_row_keyed_one") & F.col("areas_complete")
    for k in names[1:]:
        ready = ready & F.col(k)
    return out.withColumn("configuration_status", F.when(ready, "ready").otherwise("stop: fix the failing checks"))


def seed_if_empty(current: DataFrame, seed: DataFrame) -> DataFrame:
    """The rows to append: the seed if the table is empty, else none."""
    return seed if current.isEmpty() else seed.limit(0)


def in_window(df: DataFrame, time: str, settings: Settings | None, thread: str | None = None) -> DataFrame:
    """Rows from the start to before the end of the window, of the filtered thread if one is set; none without settings."""
    if settings is None:
        return df.where(F.lit(False))
    at = F.col(time)
    out = df.where((at >= F.lit(settings.review_start).cast("timestamp_ntz")) & (at < F.lit(settings.review_end).cast("timestamp_ntz")))
    return out if thread is None or settings.thread_filter is None else out.where(F.col(thread) == settings.thread_filter)
