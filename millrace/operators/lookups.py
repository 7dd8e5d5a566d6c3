"""Rows picked by a set of keys, whichever key is frequent on whichever side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import scratch_path

# A key set of at most this many rows and bytes of text is sent to all tasks;
# both are taken from the written set before the join is planned.
BROADCAST_KEYS = 1_000_000
BROADCAST_BYTES = 64 << 20


def key_set(keys: DataFrame, on: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
    """`keys` written down, one row per `on` and `more`, marked for broadcast if it is small.

    Starts a job for the keys and one for their number and size.
    """
    spark = keys.sparkSession
    path = scratch_path(spark, "keys")
    columns = [ref(c) for c in (*on, *more)]
    keys.select(*columns).distinct().write.parquet(path)
    written = spark.read.parquet(path)
    text = F.concat_ws("", *[c.cast("string") for c in columns])
    size = written.agg(
        F.count(F.lit(1)).alias("keys"), F.sum(F.octet_length(text)).alias("bytes")
    ).first()
    if size["keys"] <= BROADCAST_KEYS and (size["bytes"] or 0) <= BROADCAST_BYTES:
        written = F.broadcast(written)
    return written


def rows_with_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `df` whose `on` columns occur in `keys`; starts jobs for the key set.

    The distinct keys are written down first. A small set then filters `df`
    without moving its rows. A larger one is joined by shuffle, where AQE
    splits a frequent key of `df`: it can, as the other side is a plain scan.
    """
    return df.join(key_set(keys, on), list(on), "left_semi")
