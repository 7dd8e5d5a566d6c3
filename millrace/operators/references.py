"""Referential checks between tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contracts import Dataset, ForeignKey
from millrace.errors import ContractError
from millrace.functions.columns import ref, unused
from millrace.operators.lookups import key_set, rows_with_keys

# What the rows that lack a parent have more than others: the references that do.
MISSING_PARENTS = "missing_parents"


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose key is whole; a NULL reference is the null check's business."""
    return df.where(reduce(lambda a, b: a & b, [ref(c).isNotNull() for c in columns]))


def orphan_keys(child: DataFrame, parent: DataFrame, link: ForeignKey) -> DataFrame:
    """The references not in `parent`, each with its number of `child` rows.

    The number is the last column, `rows` unless a reference is called so.

    Both sides are brought to one row per key before they meet, so a frequent
    key weighs no more than another.
    """
    counter = unused("rows", link.columns)
    per_key = (
        _complete(child, link.columns)
        .groupBy(*[ref(c) for c in link.columns])
        .agg(F.count(F.lit(1)).alias(counter))
    )
    names = [unused(f"_p{i}", link.columns) for i in range(len(link.columns))]
    known = parent.select(
        *[ref(p).alias(n) for p, n in zip(link.parent_columns, names, strict=True)]
    ).distinct()
    on = [ref(c) == F.col(n) for c, n in zip(link.columns, names, strict=True)]
    return per_key.join(known, on, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, link: ForeignKey) -> DataFrame:
    """Rows of `child` whose reference is not in `parent`.

    Finding the orphan keys moves keys only; `child` rows are then picked by
    them, mostly without a shuffle because orphans are few.
    """
    return rows_with_keys(child, orphan_keys(child, parent, link), link.columns)


def split_orphans(
    child: DataFrame, contract: Dataset, parents: Mapping[str, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Rows of `child` whose references all have their parents, and the others with what they miss.

    The others have one more column, `missing_parents`: the references, as in
    the report, that are not in their parent table. `child` is read several
    times, so pass a written table. Its rows move only beside more orphan keys than fit a
    broadcast.
    """
    flags = []
    marked = child
    for i, link in enumerate(contract.foreign_keys):
        keys = orphan_keys(child, parents[link.parent], link)
        flag = unused(f"_orphan{i}", marked.columns)
        known = key_set(keys, link.columns).withColumn(flag, F.lit(",".join(link.columns)))
        marked = marked.join(known, list(link.columns), "left")
        flags.append(F.col(flag))
    missing = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    marked = marked.select(*[ref(c) for c in child.columns], missing.alias(MISSING_PARENTS))
    complete = F.size(MISSING_PARENTS) == 0
    return marked.where(complete).drop(MISSING_PARENTS), marked.where(~complete)


def reference_report(
    child: DataFrame, contract: Dataset, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per declared reference: orphan keys and orphan rows, 0 if all is well."""
    if not contract.foreign_keys:
        raise ContractError(f"{contract.name} declares no references")
    parts = []
    for link in contract.foreign_keys:
        found = orphan_keys(child, parents[link.parent], link)
        totals = found.agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum(ref(found.columns[-1])), F.lit(0)).cast("long").alias("orphan_rows"),
        )
        parts.append(
            totals.select(
                F.lit(contract.name).alias("dataset"),
                F.lit(",".join(link.columns)).alias("reference"),
                F.lit(link.parent).alias("parent"),
                "orphan_keys",
                "orphan_rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)
