"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "bazaarlake", **extra: str) -> SparkSession:
    """A session with the settings the library relies on; cluster settings stay as given."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="bazaarlake-")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def write_and_read(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write once as parquet in the shared folder and go on from the files.

    Cuts the lineage: what follows reads pruned columns, and a lost executor
    costs a re-read of its files and not a second parse of the raw feeds. The files
    are removed when the driver ends, as frames may read them until then.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that this run itself made."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
