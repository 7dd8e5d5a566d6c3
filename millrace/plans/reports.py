"""Reports over the logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.operators.lookups import rows_with_keys
from millrace.operators.quality import duplicate_keys
from millrace.sinks.logs import FAILED, SUCCESS


def run_totals(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attempts in the audit log: total, passed and failed, overall or per `by`."""
    return audit.groupBy(*[ref(c) for c in by]).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == SUCCESS).alias("passed"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
    )


def run_outcomes(audit: DataFrame) -> DataFrame:
    """Which datasets passed and failed, as rows: status, dataset_name, attempts."""
    return audit.groupBy("status", "dataset_name").agg(F.count(F.lit(1)).alias("attempts"))


def duplicate_loads(
    metadata: DataFrame, by: Sequence[str] = ("dataset_name", "checksum")
) -> DataFrame:
    """Content that was loaded more than once, with the number of loads."""
    return duplicate_keys(metadata, by, counter="loads")


def already_loaded(
    manifest: DataFrame, metadata: DataFrame, by: Sequence[str] = ("checksum",)
) -> DataFrame:
    """Rows of `manifest` whose content the metadata log knows."""
    return rows_with_keys(manifest, metadata, by)
