"""Incremental loads: each new file is taken up once, then the stream stops."""

from __future__ import annotations

from collections.abc import Callable, Mapping, MutableMapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Dataset
from millrace.errors import ContractError
from millrace.functions.columns import ref, unused
from millrace.operators.dedup import dedup_by_key
from millrace.operators.references import MISSING_PARENTS, split_orphans
from millrace.plans.silver import conform, conform_and_publish, publish_gated
from millrace.plans.transform import HOOKS, Hook
from millrace.session import drop_path, path_exists, scratch_path
from millrace.sinks.tables import recover, replace_table, stored_schema
from millrace.sources.readers import CSV_READ_OPTIONS, LOAD_DATE

Parents = Mapping[str, DataFrame] | Callable[[], Mapping[str, DataFrame]]

# Partition columns: whether a landed row was late, and the batch that set an orphan aside.
LATE = "late"
BATCH = "batch"


def read_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the rows in files below `path` that the query has not seen."""
    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.options(**CSV_READ_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def land_new_files(
    stream: DataFrame, path: str, checkpoint: str, load_date: Column | None = None
) -> None:
    """Append the stream's rows below `path` by load date, each exactly once.

    Rows are neither reordered nor compared, so no state is kept and late ones
    are kept too; keys are made unique by the conforming step.
    """
    query = (
        stream.withColumn(LOAD_DATE, F.current_date() if load_date is None else load_date)
        .writeStream.format("parquet")
        .partitionBy(LOAD_DATE)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_unique_new_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str],
    event_time: str,
    remember: str = "7 days",
    late_after: str = "1 day",
    spread: int = 1,
) -> None:
    """Append the first row of each key below `path`, by lateness and event date.

    Which keys have come is Spark's streaming state, so that nothing of what was
    landed is searched for them. It forgets a key `remember` after it came: the
    watermark goes by the time of arrival, which never drops a row. A key that
    comes again later than that is landed again.

    Rows whose event time is more than `late_after` before the greatest one of
    earlier runs are late. They go to the side (`late=true`), where a job that
    reads closed days does not stumble over them; see `landed`. NULL event times
    are not late, NULL keys are one key. Of rows of a key in one batch any stays.

    `spread` above 1 drops repeats in so many parts of a key first, so that one
    frequent key does not keep a single task busy; it is fixed by the checkpoint.
    """
    spark = stream.sparkSession
    arrived, part = unused("_arrived", stream.columns), unused("_part", stream.columns)
    rows = stream.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, remember)
    if spread > 1:
        rows = rows.withColumn(part, F.spark_partition_id() % spread)
        rows = rows.dropDuplicatesWithinWatermark([*key, part]).drop(part)
    rows = rows.dropDuplicatesWithinWatermark(list(key)).drop(arrived)
    time = F.col(event_time).cast("timestamp")
    mark = _greatest_event_time(spark, path, event_time)
    late = time < F.lit(mark) - F.expr(f"interval {late_after}") if mark else F.lit(False)
    query = (
        rows.withColumns({LATE: F.coalesce(late, F.lit(False)), LOAD_DATE: F.to_date(time)})
        .writeStream.format("parquet")
        .partitionBy(LATE, LOAD_DATE)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed(spark: SparkSession, path: str, late: bool | None = False) -> DataFrame:
    """What `land_unique_new_files` has landed: rows in time, late ones, or (None) both."""
    df = spark.read.parquet(path).withColumn(LATE, F.col(LATE).cast("boolean"))
    return df if late is None else df.where(F.col(LATE) == late)


def _greatest_event_time(spark: SparkSession, path: str, event_time: str) -> datetime | None:
    """The greatest event time landed in time; only the newest date is read."""
    if not path_exists(spark, f"{path}/{LATE}=false"):
        return None
    in_time = landed(spark, path)
    newest = in_time.agg(F.max(LOAD_DATE)).first()[0]
    last_day = in_time.where(F.col(LOAD_DATE) == F.lit(newest))
    return last_day.agg(F.max(F.col(event_time).cast("timestamp"))).first()[0]


def merge_new_files(
    stream: DataFrame,
    contract: Dataset,
    checkpoint: str,
    hooks: MutableMapping[str, Hook] = HOOKS,
    parents: Parents | None = None,
    orphans_path: str | None = None,
) -> None:
    """Conform, check and publish the stream's rows batch by batch.

    With write mode `merge` a batch that is run again after a failure gives
    the same table. Keys are compared with the whole table, not with a state
    that forgets: a late row of a new key is taken up, and with a `version` in
    the contract a late row of a known key does not undo a newer one.

    With `parents` (tables by dataset name, or a function that gives them anew
    for each batch) the contract's references are checked. A row without its
    parent stops the stream before its batch is published; with `orphans_path`
    such rows go there instead and the others are published. `release_orphans`
    takes them up once their parents have come.
    """
    if orphans_path and parents is None:
        raise ContractError(f"{contract.name}: orphans are found by their parents only")

    def publish(batch: DataFrame, number: int) -> None:
        given = parents() if callable(parents) else parents
        if orphans_path is None:
            conform_and_publish(batch, contract, hooks, whole=False, parents=given)
            return
        spark = batch.sparkSession
        staging = scratch_path(spark, f"batch-{contract.name}")
        try:
            conform(batch, contract, hooks).write.parquet(staging)
            rows = spark.read.parquet(staging)
            whole, orphans = split_orphans(rows, contract.conformed(), given)
            # A batch that is run again writes the same folder.
            orphans.write.mode("overwrite").parquet(f"{orphans_path}/{BATCH}={number}")
            publish_gated(whole, contract, whole=False)
        finally:
            drop_path(spark, staging)

    query = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def release_orphans(
    spark: SparkSession, contract: Dataset, orphans_path: str, parents: Mapping[str, DataFrame]
) -> int:
    """Publish the orphans whose parents have come, keep the others; the number that stay.

    The contract needs a `version`: without one an orphan could undo a newer row
    of its key. Of several orphans of a key the newest is published, and all
    that have their parents leave the side table. Run it while no stream writes
    there.
    """
    if not contract.version:
        raise ContractError(f"{contract.name}: orphans are released by version only")
    recover(spark, orphans_path)
    if stored_schema(spark, orphans_path) is None:
        return 0
    contract = contract.conformed()
    waiting = spark.read.parquet(orphans_path)
    columns = [ref(c) for c in waiting.columns if c != MISSING_PARENTS]
    ready, still = split_orphans(waiting.select(*columns), contract, parents)
    newest = dedup_by_key(ready.drop(BATCH), contract.primary_key, newest_by=contract.version)
    publish_gated(newest, contract, keys_are_unique=True, whole=False)
    replace_table(still, orphans_path, partition_columns=[BATCH])
    return spark.read.schema(still.schema).parquet(orphans_path).count()
