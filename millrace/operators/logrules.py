"""Rules that rows of the two logs must meet."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.sinks.logs import FAILED, SUCCESS

# Fields that each log row must fill.
METADATA_REQUIRED = (
    "dataset_name",
    "source_file_name",
    "row_count",
    "load_date",
    "ingestion_timestamp",
    "run_id",
)
AUDIT_REQUIRED = ("run_id", "dataset_name", "start_time", "status", "file_name")


def metadata_rules(known_datasets: Iterable[str]) -> dict[str, Column]:
    """Rule name -> condition under which a metadata row breaks it."""
    rules = {f"{c}_required": ref(c).isNull() for c in METADATA_REQUIRED}
    return rules | {
        "row_count_not_negative": F.col("row_count") < 0,
        "column_count_positive": F.coalesce(F.col("column_count"), F.lit(0)) <= 0,
        "file_size_positive": F.coalesce(F.col("file_size_bytes"), F.lit(0)) <= 0,
        "checksum_required": F.col("checksum").isNull(),
        "dataset_known": ~F.col("dataset_name").isin(list(known_datasets)),
    }


def audit_rules() -> dict[str, Column]:
    """Rule name -> condition under which an audit row breaks it."""
    rules = {f"{c}_required": ref(c).isNull() for c in AUDIT_REQUIRED}
    return rules | {
        "status_known": ~F.col("status").isin(SUCCESS, FAILED),
        "duration_not_negative": F.col("duration_seconds") < 0,
        "failure_explained": (F.col("status") == FAILED) & F.col("error_message").isNull(),
    }


def violations(
    df: DataFrame, rules: Mapping[str, Column], identity: Sequence[str]
) -> DataFrame:
    """One row per broken rule: the `identity` columns and `rule`; no shuffle."""
    broken = F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules.items()])
    return df.select(
        *[ref(c) for c in identity], F.explode(F.array_compact(broken)).alias("rule")
    )
