"""Spark session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Re-plan at run time: merge small shuffle partitions, split hot ones,
    # and turn a shuffle join into a broadcast join by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Of keyed tables and of intermediate tables of merges: texts take a third less than with snappy.
CODEC = "zstd"

_LOCAL_DIR: str | None = None


def build_session(
    app_name: str = "larkspur",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    delta: bool = False,
) -> SparkSession:
    """One session from settings; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if delta:
        settings["spark.sql.extensions"] = "io.delta.sql.DeltaSparkSessionExtension"
        settings["spark.sql.catalog.spark_catalog"] = "org.apache.spark.sql.delta.catalog.DeltaCatalog"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(endpoint: str | None, key: str | None, secret: str | None) -> dict[str, str]:
    """Hadoop settings for ``s3a://`` paths; listing pages through all keys there."""
    pairs = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": key,
        "spark.hadoop.fs.s3a.secret.key": secret,
    }
    return {k: v for k, v in pairs.items() if v}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _LOCAL_DIR
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="larkspur-")
        atexit.register(shutil.rmtree, _LOCAL_DIR, ignore_errors=True)
    return _LOCAL_DIR


def work_dir(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/larkspur/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one run."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def remove_work(spark: SparkSession) -> None:
    """Remove what the application has written as intermediate data, once no result that reads it is needed."""
    remove(spark, work_dir(spark))


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Later stages then restart from files after an executor loss, and every
    reader sees the same rows.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one piece of work: written like ``cut_lineage`` does, removed when the work is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def cut(self, df: DataFrame, label: str = "cut", *partition_by: str) -> DataFrame:
        path = work_path(self.spark, label)
        self.paths.append(path)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        """Remove one of the tables before the end."""
        self.paths.remove(path)
        remove(self.spark, path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a scan over all cores when its files give them far fewer partitions than there are cores.

    For work that is heavy per row. Only a scan that would leave three quarters of the cores idle is shuffled; any
    other, as any large table is, is returned as it is.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want, *keys) if df.rdd.getNumPartitions() * 4 <= want else df
