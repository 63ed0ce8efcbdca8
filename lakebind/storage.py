"""Reading tables, and cutting lineage in storage that every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that are sent to all tasks, at most.
AGAIN = 1_000_000
#: Tables that this process has written and not released.
_WRITTEN: list[str] = []


def release(spark: SparkSession) -> None:
    """Deletes the intermediate tables written so far; to be called when the results that read them are used up."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder`` (a file or a directory of part files)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and the master is local (tests), a new temporary one is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not folder:
        folder = f"file://{tempfile.mkdtemp(prefix='lakebind-')}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of ``df``: survives lost executors, keeps its partitioning."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a compressed table of the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def distinct_rows(df: DataFrame, key: str) -> DataFrame:
    """``df.distinct()`` for rows that are seldom repeated: only those whose key occurs again are moved and compared.

    Keys that occur again go to all tasks if they are at most ``AGAIN``.
    """
    again = cut(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(key).alias("again")))
    keys = F.broadcast(again) if again.count() <= AGAIN else again
    same = F.col(key).eqNullSafe(F.col("again"))
    return df.join(keys, same, "left_anti").unionByName(df.join(keys, same, "left_semi").distinct())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
