"""Tables that a job settles between its steps, as Parquet in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where none is set: a temporary one if all run on this machine, else an error."""
    if at := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return at
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), "checkpoints")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shelve(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there and survives lost executors.

    The shuffle files of the write go when it has ended; unshelve() deletes the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/kithline-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    made._shelf = path
    return made


def unshelve(*tables: DataFrame) -> None:
    """Delete tables that shelve() gave and nothing reads any more. What a returned DataFrame still reads must stay."""
    for df in tables:
        if path := df.__dict__.pop("_shelf", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
