"""One row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import TransformError
from millrace.functions.columns import ref, unused


def _sortable(field: T.StructField) -> Column:
    """The column, or its JSON text where its type has no order (maps, variants)."""
    try_types = field.dataType.simpleString()
    if "map<" in try_types or "variant" in try_types:
        return F.to_json(F.struct(ref(field.name)))
    return ref(field.name)


def dedup_by_key(
    df: DataFrame, key: Sequence[str], newest_by: Sequence[str] = ()
) -> DataFrame:
    """Keep one row per key; NULL keys are one key.

    The row with the greatest `newest_by` stays; ties go to the smallest row
    over all other columns, NULL first, so the outcome depends on the data only.

    Spark turns the rank filter into a group limit on both sides of the
    exchange: a map task sends at most one row per key, however many it holds.
    """
    absent = sorted((set(key) | set(newest_by)) - set(df.columns))
    if absent:
        raise TransformError(f"cannot deduplicate, columns {', '.join(absent)} are missing")
    newest = [ref(c).desc_nulls_last() for c in newest_by]
    rest = [
        _sortable(f).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in key and f.name not in newest_by
    ]
    order = newest + rest or [F.lit(0)]
    window = Window.partitionBy(*[ref(c) for c in key]).orderBy(*order)
    rank = unused("_rank", df.columns)
    return df.withColumn(rank, F.row_number().over(window)).where(ref(rank) == 1).drop(rank)
