"""Complete listings of source folders, and a verdict per source.

Spark's own file scans pass over files of no bytes, so that an empty source
looks like a missing one to them. Folders are listed inside tasks here, one per
source; what a scan ignores by its name is ignored here too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import qualified
from millrace.sources.stores import Opener, store_opener

# Verdicts on a source.
MISSING, EMPTY, OK = "missing", "empty", "ok"

_LISTED = "source string, source_path string, found boolean, file string, file_name string, file_size_bytes long"


def _lister(
    opened: Opener, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def ignored(relative: str) -> bool:
        return any(
            (part.startswith("_") and "=" not in part)
            or part.startswith(".")
            or part.endswith("._COPYING_")
            for part in relative.split("/")
        )

    def listed(source: str, path: str) -> Iterator[dict]:
        filesystem, inner = opened(path)
        row = {"source": source, "source_path": path, "found": True}
        info = filesystem.get_file_info(inner)
        if info.type == pa_fs.FileType.NotFound:
            yield row | {"found": False}
            return
        if info.type == pa_fs.FileType.File:
            name = path.rstrip("/").rsplit("/", 1)[-1]
            yield row | {"file": path, "file_name": name, "file_size_bytes": info.size}
            return
        some = False
        base = inner.rstrip("/") + "/"
        for entry in filesystem.get_file_info(pa_fs.FileSelector(inner, recursive=True)):
            relative = entry.path.removeprefix(base)
            if entry.type == pa_fs.FileType.File and not ignored(relative):
                some = True
                yield row | {
                    "file": f"{path.rstrip('/')}/{relative}",
                    "file_name": entry.base_name,
                    "file_size_bytes": entry.size,
                }
        if not some:
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = list(listed(row["source"], row["source_path"]))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def list_sources(spark: SparkSession, sources: Mapping[str, str]) -> DataFrame:
    """One row per file at or below the path of each source (name -> path), at any depth.

    Columns: source, source_path, found (the path exists), file, file_name,
    file_size_bytes. A source without files has one row whose file is NULL.
    Files of no bytes are listed. Paths are taken as they are, not as patterns.
    """
    schema = to_arrow_schema(T.StructType.fromDDL(_LISTED))
    rows = [(name, qualified(spark, path)) for name, path in sources.items()]
    paths = spark.createDataFrame(rows, "source string, source_path string")
    run = _lister(store_opener(spark), schema)
    return paths.repartition(max(1, len(rows))).mapInArrow(run, _LISTED)


def source_verdicts(listed: DataFrame) -> DataFrame:
    """(source, source_path, files, empty_files, file_size_bytes, verdict) per source.

    missing: nothing at that path. empty: no file holds a byte. ok: one does.
    """
    size = F.coalesce(F.sum("file_size_bytes"), F.lit(0))
    return listed.groupBy("source", "source_path").agg(
        F.count("file").alias("files"),
        F.count_if(F.col("file_size_bytes") == 0).alias("empty_files"),
        size.alias("file_size_bytes"),
        F.when(~F.bool_or("found"), MISSING).when(size == 0, EMPTY).otherwise(OK).alias("verdict"),
    )
