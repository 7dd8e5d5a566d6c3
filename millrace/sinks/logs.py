"""Append-only metadata and audit logs."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import struct
from millrace.functions.columns import ref
from millrace.session import drop_path, path_exists, scratch_path

# Columns and types of the two logs, and the states of a run.
METADATA_SCHEMA = struct(
    ("dataset_name", T.StringType(), True),
    ("source_file_name", T.StringType(), True),
    ("source_file_path", T.StringType(), True),
    ("file_size_bytes", T.LongType(), True),
    ("row_count", T.LongType(), True),
    ("column_count", T.IntegerType(), True),
    ("column_names", T.StringType(), True),
    ("load_date", T.DateType(), True),
    ("ingestion_timestamp", T.TimestampType(), True),
    ("checksum", T.StringType(), True),
    ("run_id", T.StringType(), True),
)
AUDIT_SCHEMA = struct(
    ("run_id", T.StringType(), True),
    ("dataset_name", T.StringType(), True),
    ("start_time", T.TimestampType(), True),
    ("end_time", T.TimestampType(), True),
    ("duration_seconds", T.IntegerType(), True),
    ("status", T.StringType(), True),
    ("records_processed", T.LongType(), True),
    ("file_name", T.StringType(), True),
    ("error_message", T.StringType(), True),
)
SUCCESS = "SUCCESS"
FAILED = "FAILED"


def _run_folder(path: str, run_id: str) -> str:
    return f"{path}/run_id={quote(run_id, safe='')}"


def append_record(
    spark: SparkSession,
    record: dict,
    path: str,
    schema: T.StructType,
    rules: Mapping[str, Column] | None = None,
) -> None:
    """Add one run's row, in a folder of its own; rows already there are not touched.

    A row that breaks one of `rules` (name -> condition under which it does)
    raises instead; the writing job checks them.

    Two jobs that append to the same folder at once would share its temporary
    files and could lose a row.
    """
    values = [F.lit(record[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    row = spark.range(1, numPartitions=1).select(*values)
    if rules:
        names = [F.when(bad, F.lit(rule)) for rule, bad in rules.items()]
        broken = F.array_compact(F.array(*names))
        complaint = F.raise_error(F.concat(F.lit("log row breaks: "), F.array_join(broken, ", ")))
        name = F.when(F.size(broken) > 0, complaint).otherwise(ref("dataset_name"))
        row = row.withColumn("dataset_name", name)
    row.drop("run_id").write.mode("append").parquet(_run_folder(path, record["run_id"]))


def _packed(path: str) -> str:
    """Where the packed rows of the log at `path` lie: beside it, with run_id as a column."""
    return f"{path.rstrip('/')}_packed"


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a log, packed or not.

    A run that is in both places counts once. The runs are listed first: one
    that a packing job has taken away by then was packed before.
    """
    runs = spark.read.schema(schema).parquet(path).select(*schema.names)
    if not path_exists(spark, _packed(path)):
        return runs
    packed = spark.read.schema(schema).parquet(_packed(path)).select(*schema.names)
    return runs.join(packed.select("run_id").distinct(), "run_id", "left_anti").select(
        *schema.names
    ).unionByName(packed)


def pack_log(
    spark: SparkSession, path: str, schema: T.StructType, day: Column, before: date
) -> int:
    """Pack the log rows of the days before `before` into few files; the number of runs packed.

    `day` tells a row's day. Appends and reads go on meanwhile. Rows are packed
    in a new folder first, and what was packed is taken out of the log only by
    the next call, so that readers that have listed it find it. A run that is
    recorded again after it was packed is not seen; run ids hold their second.
    """
    listed = lambda: spark.read.schema(schema).parquet(path).select(*schema.names)
    target, runs = _packed(path), listed()
    if path_exists(spark, target):
        packed = spark.read.schema(schema).parquet(target).select("run_id").distinct()
        gone = runs.select("run_id").distinct().join(packed, "run_id", "left_semi")
        for row in gone.toLocalIterator():
            drop_path(spark, _run_folder(path, row["run_id"]))
        runs = listed().join(packed, "run_id", "left_anti").select(*schema.names)
    closed = runs.withColumn("log_day", day).where(F.col("log_day") < F.lit(before))
    # The rows as they are now; runs that end meanwhile are for the next call.
    staged = scratch_path(spark, "pack-log")
    try:
        closed.write.parquet(staged)
        closed = spark.read.parquet(staged)
        count = closed.select("run_id").distinct().count()
        if count:
            # One file a day, or a few for a day of very many runs.
            rows = closed.hint("rebalance", F.col("log_day"))
            rows.write.mode("append").partitionBy("log_day").parquet(target)
        return count
    finally:
        drop_path(spark, staged)


def combine_logs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both logs; a column that only one of them has is NULL for the other."""
    return first.unionByName(second, allowMissingColumns=True)


def column_names(df: DataFrame):
    """A frame's column names as one comma-joined text, source order."""
    return F.concat_ws(",", *[F.lit(c) for c in df.columns])
