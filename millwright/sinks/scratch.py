"""Files in the folders that driver and executors share, and intermediate results there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in a local session without it, as in tests, a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or tempfile.mkdtemp(prefix="millwright-")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and stored, so that what follows reads it instead of redoing it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """The file or folder with all it holds; nothing if there is none."""
    place, files = _place(spark, path)
    files.delete(place, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    place, files = _place(spark, path)
    files.create(place, True).close()


def partition_path(spark: SparkSession, path: str, names, values) -> str:
    """The folder that a partition's files are in."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path.rstrip("/"), *[escape(n, None if v is None else str(v)) for n, v in zip(names, values)]])
