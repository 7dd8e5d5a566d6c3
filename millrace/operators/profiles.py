"""Size and shape of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.digests import combined_md5, row_md5

from millrace.sinks.logs import column_names


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """One row: dataset, row_count, column_count, column_names."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("dataset"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        column_names(df).alias("column_names"),
    )


def table_profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`table_profile` of each table, in one query."""
    return reduce(DataFrame.unionByName, [table_profile(df, n) for n, df in tables.items()])


def content_digest(df: DataFrame, dataset: str) -> DataFrame:
    """One row: dataset, row_count and a digest of all rows that knows no order.

    Equal for equal rows, whatever the files, partitions and order they lie in;
    a repeated row counts each time. No row gives NULL.
    """
    return df.agg(
        F.lit(dataset).alias("dataset"),
        F.count(F.lit(1)).alias("row_count"),
        combined_md5(row_md5(df.columns)).alias("content_digest"),
    )
