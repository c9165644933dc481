"""A saved table as a log of runs: each run adds a folder of its own and is published by a commit marker.

Readers take the folders that whole markers name. A run that ended half-written has no whole marker, and one that is replayed
finds its marker; neither is seen. So a run costs what it adds, whatever is saved, and nothing saved is ever rewritten.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_END = "\n"  #: of a whole marker


@dataclass(frozen=True)
class RunLog:
    """path: a folder in a store that the driver and all executors share; schema: that of every run's rows."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def _at(self, *names: str) -> tuple[JavaObject, JavaObject]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _marker(self, run: str) -> str | None:
        """The folder that a run's marker names; None without a marker, or with a torn one."""
        _checked(run)
        store, path = self._at("_commits", run)
        if not store.exists(path):
            return None
        stream = store.open(path)
        try:
            said = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return said.removesuffix(_END) if said.endswith(_END) else None

    def runs(self) -> dict[str, str]:
        """Published run -> its folder, in the order of names. As many as there were runs, whatever they hold."""
        store, path = self._at("_commits")
        names = sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []
        return {n: folder for n in names if (folder := self._marker(n)) is not None}

    def read(self, run: str | None = None) -> DataFrame:
        """The rows of all published runs, or of one; with the declared schema, which an empty log has too."""
        folders = [f"{self.path}/{folder}" for name, folder in self.runs().items() if run in (None, name)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def write(self, rows: DataFrame, run: str) -> str:
        """Writes a run's rows into a new folder, which nobody reads yet. Columns go by name."""
        _checked(run)
        folder = f"runs/{run}-{uuid.uuid4().hex}"
        rows.select(*(rows[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in self.schema)).write.parquet(f"{self.path}/{folder}")
        return folder

    def publish(self, run: str, folder: str) -> bool:
        """Makes a written folder the run's; False, and no change, if the run is published already. A torn marker is
        replaced. One driver at a time works on a run."""
        if self._marker(run) is not None:
            return False
        store, path = self._at("_commits", run)
        stream = store.create(path, True)
        try:
            stream.write((folder + _END).encode())
        finally:
            stream.close()
        return True

    def append(self, rows: DataFrame, run: str) -> bool:
        """Adds a run's rows; a run that is published already is not written again, nor are its rows computed."""
        return self._marker(run) is None and self.publish(run, self.write(rows, run))


def _checked(run: str) -> None:
    if not run or not all(c.isalnum() or c in "-_" for c in run) or run.startswith("_"):
        raise ValueError("a run's name has letters, digits, - and _")
