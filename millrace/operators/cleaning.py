"""Trimming of text and of column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import TransformError
from millrace.functions.columns import ref, repeated, standard_name


def trim_strings(df: DataFrame) -> DataFrame:
    """Cut blanks (U+0020 only) off both ends of every string column."""
    twice = repeated(df.columns)
    if twice:
        raise TransformError(f"cannot trim, columns occur twice: {', '.join(twice)}")
    return df.select(
        *[
            F.trim(ref(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def standardize_names(df: DataFrame) -> DataFrame:
    """Columns in lower case with underscores; two columns must not become one."""
    names = [standard_name(c) for c in df.columns]
    twice = repeated(names)
    if twice:
        raise TransformError(f"columns would share a name: {', '.join(twice)}")
    return df.toDF(*names)
