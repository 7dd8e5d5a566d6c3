"""Session set-up, shared scratch space and the few file-system calls the jobs need."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from functools import cache

from pyspark.sql import SparkSession

# Environment variable -> Spark setting, applied only where the variable is set,
# so that spark-submit and cluster defaults stay in force otherwise.
_FROM_ENVIRONMENT = {
    "LAKE_S3_ENDPOINT": "spark.hadoop.fs.s3a.endpoint",
    "LAKE_S3_ACCESS_KEY": "spark.hadoop.fs.s3a.access.key",
    "LAKE_S3_SECRET_KEY": "spark.hadoop.fs.s3a.secret.key",
    "SPARK_SHUFFLE_PARTITIONS": "spark.sql.shuffle.partitions",
    "SPARK_DRIVER_MEMORY": "spark.driver.memory",
    "SPARK_EXECUTOR_MEMORY": "spark.executor.memory",
}


def session_settings(environ: Mapping[str, str]) -> dict[str, str]:
    """Spark settings for a session in this environment."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        # Jobs in unlike scheduler pools share the tasks; those in one pool queue as before.
        "spark.scheduler.mode": "FAIR",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        # The JVM does not compile larger methods; for a wide table's casts
        # Spark's operator-by-operator code is faster than interpreting one.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings |= {key: environ[var] for var, key in _FROM_ENVIRONMENT.items() if environ.get(var)}
    if "spark.hadoop.fs.s3a.endpoint" in settings:
        endpoint = settings["spark.hadoop.fs.s3a.endpoint"]
        settings |= {
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "spark.hadoop.fs.s3a.path.style.access": "true",
            "spark.hadoop.fs.s3a.connection.ssl.enabled": str(
                endpoint.startswith("https://")
            ).lower(),
        }
    return settings


def get_session(app_name: str) -> SparkSession:
    """Create or return the session; the master comes from SPARK_MASTER or spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if os.environ.get("SPARK_MASTER"):
        builder = builder.master(os.environ["SPARK_MASTER"])
    for key, value in session_settings(os.environ).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A machine-local folder is used only by a local master without that setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with its scheme, as the cluster's default file system would resolve it."""
    fs, target = _hadoop(spark, path)
    return fs.makeQualified(target).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; what is at `target` must be gone."""
    fs, source_path = _hadoop(spark, source)
    target_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def drop_path(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)
