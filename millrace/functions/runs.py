"""Run identifiers, load dates and durations, all in UTC."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a run is named, `<dataset>_<UTC time to the second>`.
RUN_TIME_FORMAT_SPARK = "yyyyMMddHHmmss"
RUN_TIME_FORMAT_PYTHON = "%Y%m%d%H%M%S"


def utc_now() -> datetime:
    return datetime.now(UTC)


def new_run_id(dataset: str, started: datetime) -> str:
    return f"{dataset}_{started.astimezone(UTC):{RUN_TIME_FORMAT_PYTHON}}"


def run_id(dataset: Column, started: Column) -> Column:
    """`new_run_id` over columns; `started` is a UTC time."""
    return F.concat_ws("_", dataset, F.date_format(started, RUN_TIME_FORMAT_SPARK))


def load_date(started: Column) -> Column:
    """The one date a run's rows are filed under, so a run over midnight stays whole."""
    return F.to_date(started)


def duration_seconds(started: Column, ended: Column) -> Column:
    """Whole seconds between two timestamps, cut toward zero."""
    micros = F.unix_micros(ended.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))
    return (micros / F.lit(1_000_000)).cast("int")
