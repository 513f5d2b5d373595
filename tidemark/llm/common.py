"""Session helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegralType, NullType

from tidemark.functions.batches import small_batches  # noqa: F401 - the operators take it from here

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, a folder of this machine, but only if all of Spark runs on it."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def integer_key(df: DataFrame, key: str) -> None:
    """Operators that return least keys, or order texts by them, need keys of an integer type."""
    kind = df.schema[key].dataType
    if not isinstance(kind, IntegralType | NullType):
        raise ValueError(f"column {key!r} must be of an integer type, not {kind.simpleString()}")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends there.

    A lost executor then costs no recomputation of what is behind the table, and the shuffle files that
    made it are removed as soon as it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def write(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode(mode).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`cut` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)
