"""Facts about files: names, sizes, checksums, and whether expected ones are there."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions.columns import unused
from millrace.sources.csv_ranges import RANGE_BYTES, file_ranges
from millrace.sources.stores import Opener, store_opener

_BLOCK_BYTES = 8 << 20
_MANIFEST = "file_name string, file_size_bytes long, checksum string"


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file below `path`; contents are read only if a later step asks for them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        "content",
    )


def _hasher(
    opened: Opener, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                digest = hashlib.md5()
                filesystem, path = opened(row.pop("path"))
                with filesystem.open_input_stream(path) as stream:
                    while block := stream.read(_BLOCK_BYTES):
                        digest.update(block)
                row["checksum"] = digest.hexdigest()
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def with_checksums(files: DataFrame) -> DataFrame:
    """(file_name, file_size_bytes, checksum): the MD5 of each file of (path, file_name, file_size_bytes).

    A file is read in blocks by one task, whatever its size: an MD5 has an order.
    """
    schema = to_arrow_schema(T.StructType.fromDDL(_MANIFEST))
    narrow = files.select("path", "file_name", "file_size_bytes")
    return narrow.mapInArrow(_hasher(store_opener(files.sparkSession), schema), _MANIFEST)


def file_manifest(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Name, size and MD5 of each file that holds bytes."""
    return with_checksums(list_files(spark, path, pattern))


def _range_hasher(
    opened: Opener, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def digest(row: dict) -> dict:
        filesystem, path = opened(row["file"])
        with filesystem.open_input_file(path) as file:
            data = file.read_at(row["end"] - row["start"], row["start"])
        return row | {"md5": hashlib.md5(data).hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([digest(r) for r in batch.to_pylist()], schema=schema)

    return run


def block_manifest(
    spark: SparkSession, path: str, pattern: str | None = None, block_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Name, size, number of blocks and block checksum of each file that holds bytes.

    The block checksum is the MD5 of the hex MD5s of a file's blocks in order.
    Blocks are hashed side by side, so that a large file is no one task's work;
    the value depends on the block size alone.
    """
    files = list_files(spark, path, pattern).select(
        F.lit("").alias("source"), F.col("path").alias("file"), "file_size_bytes"
    )
    blocks = file_ranges(files, block_bytes)
    hashed = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in blocks.schema)}, md5 string"
    schema = to_arrow_schema(T.StructType.fromDDL(hashed))
    hashed = blocks.mapInArrow(_range_hasher(store_opener(spark), schema), hashed)
    in_order = F.array_sort(F.collect_list(F.struct("part", "md5")))
    found = hashed.groupBy("file", "file_size_bytes").agg(
        F.count("*").alias("blocks"),
        F.md5(F.array_join(F.transform(in_order, lambda d: d["md5"]), "")).alias("block_checksum"),
    )
    name = F.element_at(F.split("file", "/"), -1).alias("file_name")
    return found.select(name, "file_size_bytes", "blocks", "block_checksum")


def check_sources(expected: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Every row of `expected` with `valid`: is there a file for its `key` that is not empty?

    `files` holds one row per file with `key` and `length`; it is added up per
    key before the join. Files of no bytes have no row in Spark's listing.
    """
    size = unused("_bytes", expected.columns)
    found = files.groupBy(key).agg(F.sum("length").alias(size))
    valid = F.coalesce(F.col(size), F.lit(0)) > 0
    return expected.join(found, key, "left").withColumn("valid", valid).drop(size)
