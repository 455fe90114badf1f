"""Durable tables as Parquet versions.

A plain Parquet directory cannot be updated in place, so each write makes a new ``version=N``
directory. A version counts once Spark's committer has put its ``_SUCCESS`` file there; readers take
the highest such version, so a lost driver leaves the old version in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def committed_numbers(spark: SparkSession, root: str, key: str) -> list[int]:
    """Numbers N of the directories ``key=N`` below ``root`` that Spark's committer has finished."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{key}=*/_SUCCESS"))
    names = [m.getPath().getParent().getName() for m in marks or []]
    return sorted(int(n.split("=", 1)[1]) for n in names)


def current_version(spark: SparkSession, root: str) -> int | None:
    versions = committed_numbers(spark, root, "version")
    return versions[-1] if versions else None


def write_table(
    df: DataFrame, root: str, version: int | None = None, partition_by: list[str] | None = None
) -> int:
    """Write a new version of the table at ``root`` and return its number.

    A given ``version`` makes the write repeatable: doing it again replaces that version only. Without one
    the table has a single writer; a second one that took the same number fails, as the directory is there.
    Partition by low-cardinality columns (the frontier by ``status``), never by URL or host.
    """
    mode = "overwrite"
    if version is None:
        version = (current_version(df.sparkSession, root) or 0) + 1
        mode = "errorifexists"
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/version={version}")
    return version


def read_table(
    spark: SparkSession, root: str, schema: T.StructType | None = None, version: int | None = None
) -> DataFrame:
    """Latest committed version of a table, or an empty one when ``schema`` allows it."""
    if version is None:
        version = current_version(spark, root)
    if version is None:
        if schema is None:
            raise FileNotFoundError(f"no committed version in {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/version={version}")
