"""Tables that a run writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder in the cluster's shared one (spark.checkpoint.dir), so that one removal clears it. Where
    none is set, a temporary one in local mode only: on a cluster each executor would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        base = f"file://{path}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/tracewise-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: the lineage ends there and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Removes what this application has written, when no DataFrame that reads it is needed any more; whether there was any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
