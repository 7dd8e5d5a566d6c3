"""The quality gate: one job finds every problem, then the table passes or does not."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.contracts import Dataset
from millrace.errors import QualityError
from millrace.functions.columns import ref, unused
from millrace.operators.references import reference_report


@dataclass(frozen=True)
class QualityReport:
    """What the gate saw. `duplicate_records` counts keys that occur more than once."""

    dataset_name: str
    total_records: int
    duplicate_records: int
    removable_records: int
    null_counts: dict[str, int] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    # Rows without a parent, per checked reference.
    orphan_rows: dict[str, int] = field(default_factory=dict)

    @property
    def passed(self) -> bool:
        return not self.errors


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column as one row; 0 for an empty frame."""
    return df.agg(*[F.count_if(ref(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, key: Sequence[str], counter: str = "copies") -> DataFrame:
    """Keys that occur more than once and how often; NULL keys count as one key.

    A key column called like the counter lengthens the counter's name.
    """
    counter = unused(counter, key)
    return (
        df.groupBy(*[ref(c) for c in key])
        .agg(F.count(F.lit(1)).alias(counter))
        .where(ref(counter) > 1)
    )


def table_facts(df: DataFrame, checked: Sequence[str], key: Sequence[str]) -> DataFrame:
    """One row: `total`, `duplicates`, `surplus` and `n0..` NULLs of each checked column.

    Rows are counted per key first, so the exchange carries one short row per
    key and map task; NULLs of a key column need no counter of their own. The
    private names keep a key called `count` from clashing.
    """
    others = [c for c in checked if c not in key]
    narrow = df.select(
        *[ref(c).alias(f"k{i}") for i, c in enumerate(key)],
        *[ref(c).isNull().alias(f"o{i}") for i, c in enumerate(others)],
    )
    counters = [F.count(F.lit(1)).alias("n")]
    counters += [F.count_if(F.col(f"o{i}")).alias(f"o{i}") for i in range(len(others))]
    per_key = narrow.groupBy(*[f"k{i}" for i in range(len(key))]).agg(*counters)

    def nulls(column: str):
        if column in key:
            return F.when(F.col(f"k{list(key).index(column)}").isNull(), F.col("n"))
        return F.col(f"o{others.index(column)}")

    def added(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    unique = F.count_if(F.col("n") > 1) if key else F.lit(0).cast("long")
    surplus = added(F.col("n") - 1) if key else F.lit(0).cast("long")
    return per_key.agg(
        added(F.col("n")).alias("total"),
        unique.alias("duplicates"),
        surplus.alias("surplus"),
        *[added(nulls(c)).alias(f"n{i}") for i, c in enumerate(checked)],
    )


def observed(df: DataFrame, contract: Dataset) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """`df` that counts its rows and NULLs as it is written, and what gives the counts after that.

    For a table whose keys are unique by construction this is all of
    `table_facts`, without another read. Let no shuffle follow: a task of the
    writing stage counts once, however often it or another one is run again.
    """
    checked = _plan(df, contract).checked
    counts = Observation(f"gate {contract.name}")
    counters = [F.count_if(ref(c).isNull()).alias(f"n{i}") for i, c in enumerate(checked)]
    counted = df.observe(counts, F.count(F.lit(1)).alias("total"), *counters)
    return counted, lambda: {"duplicates": 0, "surplus": 0} | counts.get


def surplus_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, keys that occur more than once, and rows a dedup by `key` removes."""
    return table_facts(df, [], key).select(
        F.col("total").alias("row_count"),
        F.col("duplicates").alias("duplicate_keys"),
        F.col("surplus").alias("surplus_rows"),
    )


@dataclass(frozen=True)
class _Plan:
    """Which checks a contract asks for, given the columns that are there."""

    missing_required: list[str]
    missing_key: list[str]
    required: list[str]
    key: list[str]

    @property
    def key_only(self) -> list[str]:
        return [c for c in self.key if c not in self.required]

    @property
    def checked(self) -> list[str]:
        return self.required + self.key_only


def _plan(df: DataFrame, contract: Dataset) -> _Plan:
    there = set(df.columns)
    required = list(dict.fromkeys(contract.required_columns))
    key = list(dict.fromkeys(contract.primary_key))
    return _Plan(
        missing_required=[c for c in required if c not in there],
        missing_key=[c for c in key if c not in there],
        required=[c for c in required if c in there],
        key=[c for c in key if c in there],
    )


def quality_checks(df: DataFrame, contract: Dataset) -> DataFrame:
    """The report in long form, one row per check, still lazy.

    Columns: dataset, check, column, violations, total_records, passed.
    """
    plan = _plan(df, contract)
    facts = table_facts(df, plan.checked, plan.key)
    checks = [("required_present", c, F.lit(1)) for c in plan.missing_required]
    checks += [("key_present", c, F.lit(1)) for c in plan.missing_key]
    for i, column in enumerate(plan.checked):
        name = "required_not_null" if column in plan.required else "key_not_null"
        checks.append((name, column, F.col(f"n{i}")))
    if plan.key:
        checks.append(("key_unique", ",".join(plan.key), F.col("duplicates")))
    rows = [
        F.struct(
            F.lit(contract.name).alias("dataset"),
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            violations.cast("long").alias("violations"),
            F.col("total").alias("total_records"),
            (violations == 0).alias("passed"),
        )
        for check, column, violations in checks
    ]
    if not rows:
        empty = "dataset string, check string, column string, violations long, "
        return df.sparkSession.createDataFrame([], empty + "total_records long, passed boolean")
    return facts.select(F.inline(F.array(*rows)))


def evaluate(
    df: DataFrame,
    contract: Dataset,
    keys_are_unique: bool = False,
    parents: Mapping[str, DataFrame] | None = None,
    facts: Mapping[str, int] | None = None,
) -> QualityReport:
    """Run all checks in one job and report every problem, in the fixed order.

    Where the keys are unique by construction they are not grouped, and the
    job has no shuffle but that of one row per task; `facts` that were `observed`
    when the table was written save it. With `parents` (tables by dataset name)
    the declared references are checked too, in a second job.
    """
    plan = _plan(df, contract)
    if facts is None:
        facts = table_facts(df, plan.checked, [] if keys_are_unique else plan.key).first()
    nulls = {c: facts[f"n{i}"] for i, c in enumerate(plan.checked)}
    errors = []
    if plan.missing_required:
        errors.append(f"required, but not in the table: {', '.join(plan.missing_required)}")
    if plan.missing_key:
        errors.append(f"part of the key, but not in the table: {', '.join(plan.missing_key)}")
    errors += [f"Required column '{c}' has {nulls[c]} NULL(s)" for c in plan.required if nulls[c]]
    errors += [f"Key column '{c}' has {nulls[c]} NULL(s)" for c in plan.key_only if nulls[c]]
    if facts["duplicates"]:
        errors.append(f"{facts['duplicates']} key(s) occur more than once")
    orphans = {}
    if parents is not None and contract.foreign_keys:
        for found in reference_report(df, contract, parents).collect():
            orphans[found["reference"]] = found["orphan_rows"]
            if found["orphan_rows"]:
                errors.append(
                    f"Reference '{found['reference']}' has {found['orphan_keys']} key(s) "
                    f"that are not in {found['parent']}, in {found['orphan_rows']} row(s)"
                )
    return QualityReport(
        orphan_rows=orphans,
        dataset_name=contract.name,
        total_records=facts["total"],
        duplicate_records=facts["duplicates"],
        removable_records=facts["surplus"],
        null_counts=nulls,
        errors=errors,
    )


def gate(
    df: DataFrame,
    contract: Dataset,
    keys_are_unique: bool = False,
    parents: Mapping[str, DataFrame] | None = None,
    facts: Mapping[str, int] | None = None,
) -> QualityReport:
    """The report of a table that passes; otherwise raise with the report attached."""
    report = evaluate(df, contract, keys_are_unique, parents, facts)
    if not report.passed:
        raise QualityError(report)
    return report
