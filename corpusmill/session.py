"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# JSON keys differ by case, a repeated key keeps its last value, and times are written in one zone.
SESSION_CONF = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}

_local_scratch: str | None = None


def prepare(spark: SparkSession) -> SparkSession:
    """Set the SQL settings every operator here assumes on an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "4g", shuffle_partitions: int = 8, app: str = "corpusmill"):
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder (:func:`shared_dir`)."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Staged tables must be visible to every executor and outlive any of them, so a
    machine-local folder is accepted only when the whole application is one JVM.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="corpusmill-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        base = _local_scratch
    return base.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through the file system it lives on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
