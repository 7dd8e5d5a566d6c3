"""Files copied as they are, by the tasks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import qualified
from millrace.sources.stores import Opener, store_opener

_BLOCK_BYTES = 8 << 20
_COPIED = "file string, target string, file_size_bytes long, checksum string"


def _copier(
    opened: Opener, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def copy(row: dict) -> dict:
        digest, size = hashlib.md5(), 0
        source, inner = opened(row["file"])
        sink, target = opened(row["target"])
        folder = target.rpartition("/")[0]
        sink.create_dir(folder, recursive=True)
        # Two attempts of one task write files of their own; the later move wins.
        part = f"{folder}/_part-{uuid.uuid4().hex}"
        with source.open_input_stream(inner) as reader, sink.open_output_stream(part) as writer:
            while block := reader.read(_BLOCK_BYTES):
                digest.update(block)
                size += len(block)
                writer.write(block)
        sink.move(part, target)
        return row | {"file_size_bytes": size, "checksum": digest.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([copy(row)], schema=schema)

    return run


def copy_files(listed: DataFrame, folder: str) -> DataFrame:
    """Copies of listed source files (source_path, file) in `folder`: file, target, size, MD5.

    Byte for byte, a file a task, when the result is computed; computing it
    again copies again. A file right in its source keeps its name. One in a
    subfolder bears the folders' names before its own, `a/b.csv` as `a__b.csv`,
    so that files of one name stay apart.
    """
    spark = listed.sparkSession
    below = F.substring("file", F.length("source_path") + 2, F.length("file"))
    name = F.when(
        F.col("file") == F.col("source_path"), F.element_at(F.split("file", "/"), -1)
    ).otherwise(F.replace(F.ltrim(below, F.lit("/")), F.lit("/"), F.lit("__")))
    target = F.concat(F.lit(qualified(spark, folder).rstrip("/") + "/"), name)
    files = listed.where("file is not null").select("file", target.alias("target"))
    schema = to_arrow_schema(T.StructType.fromDDL(_COPIED))
    run = _copier(store_opener(spark), schema)
    return files.repartition(max(1, min(files.count(), 4096))).mapInArrow(run, _COPIED)
