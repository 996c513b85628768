"""Folders of tables on whatever store holds them: list, move and remove through the session's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder. The target must not be there; its parents are made."""
    fs, p = _open(spark, source)
    _, q = _open(spark, target)
    if fs.exists(q):
        raise FileExistsError(target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"could not move {source} to {target}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none if it is not there."""
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def usage(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes below ``path``."""
    fs, p = _open(spark, path)
    s = fs.getContentSummary(p)
    return s.getFileCount(), s.getLength()


def partition_folder(spark: SparkSession, column: str, value: str | None) -> str:
    """Name of the folder of a partition value, with the escapes that Spark's writers use."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, value)


def partition_values(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Folder name of each partition value (as text) that a table has; the folder of null is left out."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    start, null = f"{column}=", utils.getPartitionPathString(column, None)
    return {utils.unescapePathName(n[len(start) :]): n for n in folders(spark, path) if n.startswith(start) and n != null}
