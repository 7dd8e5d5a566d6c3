"""Bringing a frame to its declared columns and types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import SchemaError
from millrace.functions.casts import lenient_cast
from millrace.functions.columns import ref


def require_columns(df: DataFrame, schema: T.StructType, name: str) -> None:
    """Raise with all absent columns at once; names must match in case."""
    absent = sorted(set(schema.fieldNames()) - set(df.columns))
    if absent:
        raise SchemaError(f"{name}: columns {', '.join(absent)} are missing")


def enforce_schema(
    df: DataFrame, schema: T.StructType, name: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Exactly the declared columns, in declared order, cast to their types.

    Other columns are dropped, save those in `keep` (a load date that a later
    step still sorts by).
    """
    require_columns(df, schema, name)
    found = {f.name: f.dataType for f in df.schema.fields}
    typed = [
        lenient_cast(ref(f.name), found[f.name], f.dataType).alias(f.name) for f in schema.fields
    ]
    return df.select(*typed, *[ref(c) for c in keep if c not in schema.fieldNames()])


def cast_failures(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Per declared column, how many values the cast turns into NULL; one pass, no shuffle of rows."""
    require_columns(df, schema, name)
    found = {f.name: f.dataType for f in df.schema.fields}
    lost = [
        F.count_if(
            ref(f.name).isNotNull()
            & lenient_cast(ref(f.name), found[f.name], f.dataType).isNull()
        ).alias(f"c{i}")
        for i, f in enumerate(schema.fields)
    ]
    rows = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.col(f"c{i}").alias("lost_values"))
            for i, f in enumerate(schema.fields)
        ]
    )
    return df.agg(*lost).select(F.inline(rows))
