"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _test_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"pingzones-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only for a local test session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _test_folder(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, for a written intermediate table."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/pingzones/{application}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to ``folder`` and read again, which ends its plan and lineage there."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def mark_path(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    system, place = _file_system(spark, path)
    system.create(place, True).close()


def release(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table, once nothing reads it any more."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, place = _file_system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, read by the driver."""
    system, place = _file_system(spark, path)
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole under a name that is free; False if it is taken."""
    system, place = _file_system(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    beside = hadoop.Path(f"{place.getParent()}/.{uuid.uuid4().hex}")
    out = system.create(beside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = hadoop.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(hadoop, "Options$Rename")
    strict = spark.sparkContext._gateway.new_array(kind, 1)
    strict[0] = kind.NONE
    try:
        context.rename(context.makeQualified(beside), context.makeQualified(place), strict)
    except Exception as error:  # py4j wraps every Java error alike
        system.delete(beside, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True
