"""Session and table access shared by all operators."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def make_session(app: str = "rostrum", cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SMALL = 8 << 20
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Only a local
    session (tests, benches) may lack it and gets a temporary folder, once; on a cluster
    its absence is an error, since executors can't read each other's local folders."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="rostrum-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
    sc.setCheckpointDir(at)
    return sc._jsc.sc().getCheckpointDir().get()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path for a written table in the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(spark or df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage with a table written to the shared folder."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # an empty table may have no file


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path on it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def release(spark: SparkSession) -> None:
    """Deletes the tables written by ``materialize``: call it once the results are stored."""
    while _WRITTEN:
        fs, at = file_system(spark, _WRITTEN.pop())
        fs.delete(at, True)


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size, from the files' sizes; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Splits an input of at most SMALL bytes, perhaps one row group, over the cores for a
    CPU-bound map. So no more than SMALL bytes are ever shuffled for it."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism) if input_bytes(df) <= SMALL else df
