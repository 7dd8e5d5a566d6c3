"""Opening of files inside tasks, where Spark's own readers give rows instead of bytes."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyarrow import fs as pa_fs
from pyspark.sql import SparkSession

Opener = Callable[[str], tuple[pa_fs.FileSystem, str]]


def store_opener(spark: SparkSession) -> Opener:
    """A function from a full path to its file system and the path within it.

    It knows local files, S3-compatible stores by the settings Hadoop was given,
    and what the Arrow file systems know. An inner function travels to the
    workers as it is, so that they need not have this package.
    """
    names = ("endpoint", "access.key", "secret.key")
    conf = spark._jsc.hadoopConfiguration()
    storage = {n: v for n in names if (v := conf.get(f"fs.s3a.{n}"))}

    def opened(path: str) -> tuple[pa_fs.FileSystem, str]:
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return pa_fs.LocalFileSystem(), "/" + rest.lstrip("/")
        if scheme in ("s3", "s3a", "s3n"):
            options = {
                "endpoint_override": storage.get("endpoint"),
                "access_key": storage.get("access.key"),
                "secret_key": storage.get("secret.key"),
            }
            given = {k: v for k, v in options.items() if v}
            return pa_fs.S3FileSystem(**given), rest.lstrip("/")
        return pa_fs.FileSystem.from_uri(quote(path, safe=":/"))

    return opened
