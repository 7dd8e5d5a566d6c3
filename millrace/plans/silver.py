"""From landed rows to a published table."""

from __future__ import annotations

from collections.abc import Mapping, MutableMapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from millrace.contracts import Dataset
from millrace.operators.quality import QualityReport, gate, observed
from millrace.operators.schema import enforce_schema
from millrace.plans.transform import HOOKS, Hook, transform
from millrace.session import drop_path, scratch_path
from millrace.sinks.tables import clustered, write_table
from millrace.sources.readers import LOAD_DATE, read_bronze


def conform(
    df: DataFrame, contract: Dataset, hooks: MutableMapping[str, Hook] = HOOKS
) -> DataFrame:
    """Declared columns and types, then the conforming chain; lazy.

    Of several loads of a key the newest stays.
    """
    newest = [LOAD_DATE] if LOAD_DATE in df.columns else []
    typed = enforce_schema(df, contract.schema, contract.name, keep=newest)
    order = [*contract.version, *newest]
    return transform(typed, contract, newest_by=order, hooks=hooks)


def gated(
    df: DataFrame,
    contract: Dataset,
    path: str,
    keys_are_unique: bool = False,
    parents: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, QualityReport]:
    """`df` written to `path` and read back, once it has passed the gate; raise if not.

    Rows are computed once. Where keys are unique by construction the writing
    tasks count what the gate needs to know; else it reads the checked columns
    of what was written.
    """
    rows, facts = clustered(df, contract.partition_columns), None
    if keys_are_unique:
        rows, facts = observed(rows, contract)
    rows.write.parquet(path)
    written = df.sparkSession.read.parquet(path)
    return written, gate(written, contract, keys_are_unique, parents, facts and facts())


def conform_and_publish(
    df: DataFrame,
    contract: Dataset,
    hooks: MutableMapping[str, Hook] = HOOKS,
    whole: bool = True,
    parents: Mapping[str, DataFrame] | None = None,
) -> QualityReport:
    """`conform`, then `publish_gated`; deduplicated keys that no hook has touched are unique."""
    deduplicated = contract.drop_duplicates and bool(contract.primary_key)
    return publish_gated(
        conform(df, contract, hooks),
        contract,
        keys_are_unique=deduplicated and contract.name not in hooks,
        whole=whole,
        parents=parents,
    )


def publish_gated(
    df: DataFrame,
    contract: Dataset,
    keys_are_unique: bool = False,
    whole: bool = True,
    parents: Mapping[str, DataFrame] | None = None,
) -> QualityReport:
    """Publish `df` if it passes the gate, raise and publish nothing if not.

    An overwrite with the `whole` dataset leaves no partition of an earlier one;
    with a part of it, partitions without rows in `df` stay as they are. With
    `parents` (tables by dataset name) no reference may lack its parent.
    From staging to the table, rows are copied without a shuffle.
    """
    spark = df.sparkSession
    contract = contract.conformed()
    staging = scratch_path(spark, f"silver-{contract.name}")
    try:
        staged, report = gated(df, contract, staging, keys_are_unique, parents)
        write_table(
            staged,
            contract.silver_path,
            write_format=contract.write_format,
            mode=contract.write_mode,
            compression=contract.compression,
            partition_columns=contract.partition_columns,
            key=contract.primary_key,
            version=contract.version,
            rows_are_clustered=True,
            whole=whole,
        )
        return report
    finally:
        drop_path(spark, staging)


def run_silver(
    spark: SparkSession,
    contract: Dataset,
    load_dates: str | Sequence[date] | None = None,
    hooks: MutableMapping[str, Hook] = HOOKS,
    parents: Mapping[str, DataFrame] | None = None,
) -> QualityReport:
    """Read, conform, check and publish one dataset; chosen load dates are a part of it."""
    landed = read_bronze(spark, contract, load_dates)
    whole = load_dates is None or load_dates == "latest"
    return conform_and_publish(landed, contract, hooks, whole, parents)
