"""Tables that cut the lineage of a plan whose parts are read more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The folder of this session's tables in the shared folder of ``spark.checkpoint.dir``; a local session without it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not str(spark.sparkContext.master).startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.gettempdir() + "/catalink-work"
    return f"{folder.rstrip('/')}/catalogs/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the work folder and read again, so that it is evaluated once, whatever reads it."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cleared(spark: SparkSession) -> None:
    """Deletes all tables of this session. Frames that were made of them can't be read any more, so a session calls this when it has its results."""
    deleted(spark, work_dir(spark))
