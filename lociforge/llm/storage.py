"""Intermediate tables in the folder that all executors share.

``materialize`` cuts a plan's lineage by writing Parquet below ``spark.checkpoint.dir``: the files are committed, so they
survive a lost executor, and rereading them costs less than computing them again.  Where the setting is absent
(tests, a laptop) a folder of the driver is used once per session.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder: the session's ``spark.checkpoint.dir``, else one set here for local sessions."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {_SETTING} to a folder that the driver and all executors share")
    spark.conf.set(_SETTING, root := tempfile.mkdtemp(prefix="lociforge-"))
    return root


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a DataFrame that reads it."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lociforge_path = path
    tidy(spark)
    return out


def tidy(spark: SparkSession) -> None:
    """Lets Spark's context cleaner drop the shuffle files of plans that nothing refers to any more.

    It acts when the driver's JVM collects garbage, which a driver that only plans may not do for hours.
    """
    gc.collect()
    spark._jvm.System.gc()


def release(df: DataFrame) -> None:
    """Deletes what ``materialize`` wrote for ``df``; later reads of ``df`` fail."""
    path = getattr(df, "_lociforge_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
