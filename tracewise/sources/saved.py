"""A saved table of identities that is merged into without being shuffled.

Rows lie in buckets of their identity, so that a join with them moves the batch only. Beside the rows lie bitmaps of the
slots that identities fall into: a batch's row whose slot is empty is new without any look at the saved rows, and only the
others, mostly rows that are saved, are looked up. Bitmaps are written before rows: a run that ends in between leaves rows
to be looked up in vain, never rows that are taken for new.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewise.sources.scratch import materialise

SLOT_BITS = 30  #: a thousand million slots, 128 MB of bitmaps at most; full maps cost look-ups, not rows
MAP_SLOTS = 1 << 15  #: slots of one bitmap, as bitmap_construct_agg makes them
BUCKET_ROWS = 1 << 18  #: rows of a bucket, which one task writes, reads and joins with
LEAST_BUCKETS = 8


def buckets_for(rows: int) -> int:
    """Buckets of a table that is to hold so many rows, so that no task's share grows with the table."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class SavedTable:
    """path: a folder in a store that the driver and all executors share; schema: of the rows; key: their identity, a string;
    buckets: fixed when the table is made, in proportion to what it is to hold (buckets_for)."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    buckets: int = 64
    slot_bits: int = SLOT_BITS

    @property
    def _name(self) -> str:
        return f"saved_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"

    def rows(self) -> DataFrame:
        """All saved rows, in buckets of their key. The session's catalog is told of the folder; nothing is moved."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'")
        self.spark.catalog.refreshTable(self._name)
        return self.spark.table(self._name)

    def _placed(self, rows: DataFrame) -> DataFrame:
        """rows with the map and the place in it of their key's slot."""
        slot = F.pmod(F.xxhash64(self.key), F.lit(1 << self.slot_bits))
        return rows.withColumn("_slot", slot).withColumns({"_map": F.expr(f"_slot div {MAP_SLOTS}"), "_at": F.expr(f"_slot % {MAP_SLOTS}")}).drop("_slot")

    def _maps(self) -> DataFrame:
        """(_map, _bits) of all slots that any saved row falls into, one row for each map."""
        try:
            found = self.spark.read.schema("_map long, _bits binary").parquet(f"{self.path}/maps")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], "_map long, _bits binary")
        return found.groupBy("_map").agg(F.bitmap_or_agg("_bits").alias("_bits"))

    def suspects(self, batch: DataFrame) -> DataFrame:
        """batch with `_suspect`: whether a saved row falls into the slot of its key. Never false for a key that is saved."""
        byte = F.conv(F.hex(F.substr("_bits", F.expr("cast(_at div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(byte, F.expr("cast(_at % 8 as int)")), F.lit(0)) == 1
        return self._placed(batch).join(self._maps(), "_map", "left").select(*batch.columns, hit.alias("_suspect"))

    def unsaved(self, batch: DataFrame) -> DataFrame:
        """The rows of batch whose key is not saved, one for each key; rows with a null key are new, one of all. Rows with
        equal keys are taken to be equal, so any of them will do."""
        found = materialise(self.suspects(batch.dropDuplicates([self.key])), "suspects")
        clear, maybe = found.where("not _suspect").drop("_suspect"), found.where("_suspect").drop("_suspect")
        if maybe.isEmpty():
            return clear
        return clear.unionByName(looked_up(maybe, self.rows(), self.key))

    def merge(self, batch: DataFrame) -> DataFrame:
        """Adds what is new of batch (columns by name) and returns it. Running it again adds nothing. One merge at a time."""
        new = materialise(self.unsaved(batch.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema))), "new")
        self.rows()
        maps = self._placed(new.where(F.col(self.key).isNotNull()).select(self.key)).groupBy("_map").agg(F.bitmap_construct_agg("_at").alias("_bits"))
        maps.write.mode("append").parquet(f"{self.path}/maps")
        # Each bucket is one file of a run, not one of every task.
        dealt = new.repartition(self.buckets, self.key)
        dealt.write.mode("append").bucketBy(self.buckets, self.key).format("parquet").option("path", f"{self.path}/rows").saveAsTable(self._name)
        return new


def looked_up(maybe: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """Rows of maybe whose key no saved row has. Saved rows stay in their buckets and stream past a table of maybe's keys."""
    found = saved.select(key).join(maybe.select(key).hint("shuffle_hash"), key, "left_semi").distinct()
    return maybe.join(found, key, "left_anti")
