"""Publishing of tables: overwrite, append, and upsert by key."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import ContractError
from millrace.functions.columns import ref
from millrace.operators.dedup import dedup_by_key
from millrace.session import drop_path, path_exists, scratch_root


def clustered(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Rows brought together by output partition, so that each gets few files.

    AQE sizes the tasks: it merges small partitions and splits one that holds
    a large share of the rows.
    """
    return df.hint("rebalance", *[ref(c) for c in partition_columns]) if partition_columns else df


def write_table(
    df: DataFrame,
    path: str,
    *,
    write_format: str = "parquet",
    mode: str = "overwrite",
    compression: str = "snappy",
    partition_columns: Sequence[str] = (),
    key: Sequence[str] = (),
    version: Sequence[str] = (),
    rows_are_clustered: bool = False,
    whole: bool = False,
) -> None:
    """Write `df` to `path`.

    `overwrite` of a partitioned table replaces only the partitions that `df`
    has rows for, unless `df` is the `whole` table; `merge` is an upsert by `key`. Rows that already
    lie together by partition are not shuffled again. A write to the table that
    broke off is completed first, unless all of it is replaced.
    """
    if mode == "merge":
        upsert(
            df,
            path,
            key,
            write_format=write_format,
            compression=compression,
            partition_columns=partition_columns,
            version=version,
        )
        return
    spark = df.sparkSession
    if mode == "overwrite" and (whole or not partition_columns):
        # Nothing of a write that broke off would be left.
        drop_path(spark, _staging(spark, path))
    else:
        recover(spark, path)
    if not rows_are_clustered:
        df = clustered(df, partition_columns)
    _write(df, path, write_format, mode, compression, partition_columns, "static" if whole else "dynamic")


def _write(
    df: DataFrame,
    path: str,
    write_format: str,
    mode: str,
    compression: str,
    partition_columns: Sequence[str],
    overwrite: str,
) -> None:
    writer = df.write.format(write_format).mode(mode).option("compression", compression)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
        writer = writer.option("partitionOverwriteMode", overwrite)
    writer.save(path)


def _same_key(key: Sequence[str], left: str, right: str) -> Column:
    """Equality of all key columns, NULL equal to NULL."""
    pairs = [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in key]
    return reduce(lambda a, b: a & b, pairs)


def merge_rows(
    base: DataFrame, changes: DataFrame, key: Sequence[str], version: Sequence[str] = ()
) -> DataFrame:
    """Rows of `base` without a successor in `changes`, plus all of `changes`.

    With `version` columns the row of a key that has the greatest version stays,
    wherever it comes from, so that a late or repeated batch undoes nothing.
    """
    if version:
        return dedup_by_key(base.unionByName(changes), key, newest_by=version)
    kept = base.alias("b").join(
        changes.select(*[ref(k) for k in key]).alias("c"), _same_key(key, "b", "c"), "left_anti"
    )
    return kept.unionByName(changes)


def _same_columns(base: DataFrame, changes: DataFrame, path: str) -> None:
    """Raise if the changes lack, add or retype a column: nothing of a table is lost silently."""
    there = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    given = {f.name: f.dataType.simpleString() for f in changes.schema.fields}
    wrong = sorted(n for n in there.keys() | given.keys() if there.get(n) != given.get(n))
    if wrong:
        raise ContractError(f"{path}: columns differ between table and changes: {', '.join(wrong)}")


def upsert(
    changes: DataFrame,
    path: str,
    key: Sequence[str],
    *,
    write_format: str = "parquet",
    compression: str = "snappy",
    partition_columns: Sequence[str] = (),
    version: Sequence[str] = (),
) -> None:
    """Insert or replace rows of the table at `path` by `key`.

    `changes` has unique keys, the table's columns, and is read several times,
    so pass a written table. Only the partitions that changed rows lie in or
    come from are read and replaced. Their next state is complete in a redo
    record before anything of the table goes: a run that breaks off leaves the
    table as it was, or is completed by `recover`, which every later write to
    the table starts with.
    """
    spark = changes.sparkSession
    parts = list(partition_columns)
    recover(spark, path)
    found = stored_schema(spark, path, write_format)
    if found is None:
        replace_table(changes, path, write_format, compression, parts)
        return
    # Types of partition columns come from the changes; a listing would guess them.
    types = {f.name: f for f in changes.schema.fields if f.name in parts}
    schema = T.StructType([types.get(f.name, f) for f in found.fields])
    base = spark.read.format(write_format).schema(schema).load(path)
    _same_columns(base, changes, path)
    if not parts:
        replace_table(merge_rows(base, changes, key, version), path, write_format, compression)
        return
    if changes.isEmpty():
        return
    listed = f"{_staging(spark, path)}/touched"
    _touched(base, changes, key, parts).write.mode("overwrite").parquet(listed)
    touched = spark.read.schema(T.StructType([types[p] for p in parts])).parquet(listed)
    kept = base.alias("b").join(touched.alias("c"), _same_key(parts, "b", "c"), "left_semi")
    merged = merge_rows(kept, changes, key, version)
    _stage(merged, path, write_format, compression, parts, whole=False)
    _publish_staged(spark, path)


def stored_schema(
    spark: SparkSession, path: str, write_format: str = "parquet"
) -> T.StructType | None:
    """The columns of the table at `path`, if there is one."""
    try:
        return spark.read.format(write_format).load(path).schema
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _folder(spark: SparkSession, column: str, value: str | None) -> str:
    """A partition's folder name as Spark writes it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    empty = "__HIVE_DEFAULT_PARTITION__"
    return f"{escape(column)}={escape(value) if value else empty}"


def _touched(
    base: DataFrame, changes: DataFrame, key: Sequence[str], parts: Sequence[str]
) -> DataFrame:
    """The partitions that changes go to, and those where their keys lie now. Keys alone are read."""
    target = changes.select(*[ref(p) for p in parts])
    if set(parts) <= set(key):
        return target.distinct()
    narrow = base.select(*[ref(c) for c in dict.fromkeys([*key, *parts])]).alias("b")
    keys = changes.select(*[ref(k) for k in key]).alias("c")
    source = narrow.join(keys, _same_key(key, "b", "c"), "left_semi")
    return target.union(source.select(*[ref(p) for p in parts])).distinct()


def _staging(spark: SparkSession, path: str) -> str:
    """Where the redo record of the table at `path` lies; fixed per table.

    rows: the next state, of the whole table or of the touched partitions.
    touched: these partitions. intent: how to write them; written last, so that
    a record with an intent is complete.
    """
    return f"{scratch_root(spark)}/replace-{hashlib.md5(path.encode()).hexdigest()}"


_INTENT = "write_format string, compression string, partition_columns array<string>, whole boolean"


def _stage(
    df: DataFrame,
    path: str,
    write_format: str,
    compression: str,
    partition_columns: Sequence[str],
    whole: bool,
) -> None:
    """Write the redo record of a table; from here on it will be completed, by this run or a later one."""
    spark = df.sparkSession
    staging = _staging(spark, path)
    clustered(df, partition_columns).write.mode("overwrite").parquet(f"{staging}/rows")
    row = (write_format, compression, list(partition_columns), whole)
    intent = spark.createDataFrame([row], _INTENT).coalesce(1)
    intent.write.mode("overwrite").parquet(f"{staging}/intent")


def _publish_staged(spark: SparkSession, path: str) -> None:
    """Bring the table to the state of its redo record; doing it again changes nothing.

    Rows are written first and partitions that lost their last row go after
    that, so that no row is ever without a place.
    """
    staging = _staging(spark, path)
    intent = spark.read.schema(_INTENT).parquet(f"{staging}/intent").first()
    rows = spark.read.parquet(f"{staging}/rows")
    parts = intent.partition_columns
    overwrite = "static" if intent.whole else "dynamic"
    _write(rows, path, intent.write_format, "overwrite", intent.compression, parts, overwrite)
    if not intent.whole:
        touched = spark.read.parquet(f"{staging}/touched")
        filled = rows.select(*[ref(p) for p in parts]).distinct()
        gone = touched.alias("b").join(filled.alias("c"), _same_key(parts, "b", "c"), "left_anti")
        for row in gone.select(*[ref(p).cast("string") for p in parts]).toLocalIterator():
            folders = [_folder(spark, p, v) for p, v in zip(parts, row, strict=True)]
            drop_path(spark, "/".join([path.rstrip("/"), *folders]))
    drop_path(spark, f"{staging}/intent")
    drop_path(spark, staging)


def recover(spark: SparkSession, path: str) -> bool:
    """Complete a write to the table at `path` that broke off; whether there was one."""
    pending = path_exists(spark, f"{_staging(spark, path)}/intent/_SUCCESS")
    if pending:
        _publish_staged(spark, path)
    return pending


def replace_table(
    df: DataFrame,
    path: str,
    write_format: str = "parquet",
    compression: str = "snappy",
    partition_columns: Sequence[str] = (),
) -> None:
    """Replace the whole table at `path` by `df`, which may read that very table.

    The new rows are complete in a redo record before the old ones go. If the
    driver dies between the two, `recover` or the next write finishes the copy.
    """
    _stage(df, path, write_format, compression, partition_columns, whole=True)
    _publish_staged(df.sparkSession, path)
