"""Session settings and reliable lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local(spark: SparkSession) -> bool:
    """If driver and executors are one process."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster; a scratch folder only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
    elif local(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bazaarmill-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.sparkContext.getCheckpointDir()


def run_root(spark: SparkSession) -> str:
    """Folder of all tables that this application stores in between; ``drop_run`` removes it."""
    return f"{checkpoint_folder(spark)}/bazaarmill/{spark.sparkContext.applicationId}"


def drop_run(spark: SparkSession) -> None:
    """Removes the tables stored in between. Frames that are built on them can't be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freeze(df: DataFrame) -> DataFrame:
    """Write the rows to a new table in the checkpoint folder and continue from there.

    The table is columnar: each later use reads only the columns it needs, and a lost executor
    re-reads its part instead of repeating the plan above.
    """
    spark = df.sparkSession
    path = f"{run_root(spark)}/frozen/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
