"""What several operators need: shared scratch tables and connected components."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.sources.scratch import materialise


BATCH_ROWS = 512  #: of an Arrow batch; whole texts are in it, so it bounds what the JVM and a Python worker hold of them
BATCH_BYTES = 8 << 20  #: from which no further row joins a batch; very long texts travel nearly alone


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows and BATCH_BYTES at most, or one row, for what the session plans from now on. A
    smaller setting of rows stays, and any of bytes."""
    rows, size = (f"spark.sql.execution.arrow.{k}PerBatch" for k in ("maxRecords", "maxBytes"))
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    if spark.conf.get(size, None) is None:
        spark.conf.set(size, BATCH_BYTES)


def slices(texts: list[str | None], size: int) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive runs of texts of `size` characters together at most; a longer text is a run by itself."""
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and (end == at or n + len(texts[end] or "") <= size):
            n += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def give_back(run: Callable[..., Iterable]) -> Callable[..., Iterator]:
    """A task's generator that, when it ends, returns what the worker's allocators hold but do not use; workers live on
    between stages, and what each stage has needed at most would add up."""

    @wraps(run)
    def wrapped(*args: Any) -> Iterator:
        try:
            yield from run(*args)
        finally:
            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library, which keeps to its own rules
                pass

    return wrapped


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What make() gives, once a worker process. Functions travel by value, so a module's own variables are new in each task."""
    store = sys.modules.setdefault("_tracewise_kept", types.ModuleType("_tracewise_kept"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node reachable.

    edges: two bigint columns. Each round points every node to its smallest neighbour, follows the pointers twice and
    contracts the graph; rounds grow with the logarithm of the diameter. Only the number of edges reaches the driver.
    """
    a, b = edges.columns
    e = materialise(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    labels = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        for _ in range(2):
            parent = materialise(parent, "parents")
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("q"))
            parent = parent.join(up, "p").select("u", F.col("q").alias("p"))
        parent = materialise(parent, "parents")
        to = lambda c: parent.select(F.col("u").alias(c), F.col("p").alias(f"{c}2"))
        e = materialise(
            e.join(to("u"), "u").join(to("v"), "v").where("u2 != v2")
            .select(F.greatest("u2", "v2").alias("u"), F.least("u2", "v2").alias("v")).distinct(), "edges",
        )
        if labels is None:
            labels = parent.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            labels = materialise(
                labels.join(to("component"), "component", "left")
                .select("node", F.coalesce("component2", "component").alias("component")), "labels",
            )
    return labels if labels is not None else e.select(F.col("u").alias("node"), F.col("v").alias("component"))


FILTER_BITS = 1 << 26  #: of a membership filter: 8 MB, however many ids it holds
_BUCKET = 1 << 15


def may_hold(rows: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ids, rows whose key certainly is not), by a bitmap of fixed size.

    The bitmap is what is broadcast, so wide rows are shuffled only if they may be needed. Beyond tens of millions of
    ids it fills up and lets more rows through, which costs time but no rows. Null keys are certainly not among ids.
    """
    at = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(FILTER_BITS))
    bits = (
        ids.where(F.col(key).isNotNull()).select(at.alias("at")).groupBy(F.expr(f"`at` div {_BUCKET}").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.col("at") % _BUCKET).alias("_bits"))
    )
    bits = materialise(bits, "filter")
    flagged = rows.withColumn("_at", at).withColumn("_bucket", F.expr(f"_at div {_BUCKET}")).join(F.broadcast(bits), "_bucket", "left")
    byte = F.conv(F.hex(F.substr("_bits", F.expr(f"cast(_at % {_BUCKET} div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    hit = F.col(key).isNotNull() & (F.coalesce(F.getbit(byte, F.expr("cast(_at % 8 as int)")), F.lit(0)) == 1)
    return flagged.where(hit).select(rows.columns), flagged.where(~hit).select(rows.columns)


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ids; those with a null key stay."""
    ids = materialise(ids.select(key).distinct(), "ids")
    maybe, clear = may_hold(rows, ids, key)
    return clear.unionByName(maybe.join(ids, key, "left_anti"))
