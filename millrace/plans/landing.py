"""Landing of source files: check, checksum, copy, log."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from millrace.contracts import Dataset, select_datasets
from millrace.errors import LandingError
from millrace.functions.columns import ref
from millrace.functions.digests import combined_md5
from millrace.functions.runs import new_run_id, utc_now
from millrace.operators.logrules import audit_rules, metadata_rules
from millrace.session import drop_path, move_path, scratch_path
from millrace.sinks.files import copy_files
from millrace.sinks.logs import AUDIT_SCHEMA, FAILED, METADATA_SCHEMA, SUCCESS, append_record
from millrace.sources.csv_ranges import (
    RANGE_BYTES,
    csv_file_facts,
    range_facts,
    read_records,
    record_spans,
)
from millrace.sources.files import with_checksums
from millrace.sources.listing import OK, list_sources, source_verdicts
from millrace.sources.readers import CSV_READ_OPTIONS, LOAD_DATE, all_strings, read_table

# Written as read: NULL and the empty string stay apart, blanks stay.
_RAW_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "partitionOverwriteMode": "dynamic",
}
_NO_VALUE = "\u0000"
_MALFORMED = "_malformed"


@dataclass(frozen=True)
class Logs:
    """Where the two logs are."""

    metadata: str
    audit: str


@dataclass(frozen=True)
class LandedRun:
    """One successful landing."""

    run_id: str
    dataset: str
    load_date: date
    row_count: int
    checksum: str


@dataclass(frozen=True)
class RunSummary:
    """Outcome of landing several datasets; `failed` maps names to messages."""

    succeeded: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return len(self.succeeded) + len(self.failed)


@dataclass(frozen=True)
class _Source:
    """What is known of a source before it is copied.

    `spans` are the pieces in which its records are read, if line ends lie
    inside quotes; `scratch` is what they need on disk.
    """

    size: int
    checksum: str
    files: int
    first_file: str
    spans: DataFrame | None = None
    scratch: str | None = None


def _inspect(spark: SparkSession, contract: Dataset) -> _Source:
    """Count, size and checksum of the source files; raise if they cannot be landed as they are.

    The files are read once in byte ranges, before any landed row is touched.
    Text that is no UTF-8, a quote that is never closed, line breaks inside
    quotes of a source that is not declared `multiline`, and files with unlike
    headers would be landed as other rows.
    """
    listed = list_sources(spark, {contract.name: contract.source_path})
    verdict = source_verdicts(listed).first()
    if verdict["verdict"] != OK:
        raise LandingError(f"source is {verdict['verdict']}: {contract.source_path}")
    scratch = None
    expected = verdict["files"] + verdict["file_size_bytes"] // RANGE_BYTES
    ranges = range_facts(listed, expected=expected)
    if contract.multiline:
        scratch = scratch_path(spark, f"ranges-{contract.name}")
        ranges.write.parquet(scratch)
        ranges = spark.read.schema(ranges.schema).parquet(scratch)
    file_name = F.element_at(F.split("file", "/"), -1)
    found = (
        csv_file_facts(ranges)
        .withColumn("file_name", file_name)
        .agg(
            F.min("file").alias("first_file"),
            F.bool_and(F.col("md5").isNotNull()).alias("all_hashed"),
            combined_md5(F.col("md5")).alias("checksum"),
            F.min(F.when(~F.col("is_utf8"), F.col("file_name"))).alias("encoding"),
            F.min(F.when(F.col("open_quote"), F.col("file_name"))).alias("open_quote"),
            F.min(F.when(F.col("quoted_breaks"), F.col("file_name"))).alias("breaks"),
            (F.min("header_md5") == F.max("header_md5")).alias("one_header"),
        )
        .first()
    )
    if found["encoding"]:
        raise LandingError(f"{contract.name}: {found['encoding']} is not UTF-8")
    if found["open_quote"]:
        raise LandingError(f"{contract.name}: {found['open_quote']} ends inside quotes")
    if found["breaks"] and not contract.multiline:
        raise LandingError(
            f"{contract.name}: {found['breaks']} has line breaks inside quotes; declare multiline"
        )
    if not found["one_header"]:
        raise LandingError(f"{contract.name}: the source's files differ in their headers")
    checksum = found["checksum"]
    if not found["all_hashed"]:
        whole = listed.where("file_size_bytes > 0").withColumnRenamed("file", "path")
        checksum = with_checksums(whole).agg(combined_md5(F.col("checksum"))).first()[0]
    spans = record_spans(ranges) if found["breaks"] else None
    size, files = verdict["file_size_bytes"], verdict["files"]
    return _Source(size, checksum, files, found["first_file"], spans, scratch)


def read_raw(spark: SparkSession, contract: Dataset, source: _Source | None = None) -> DataFrame:
    """The source's rows as text.

    A row with more fields than the header fails the query, a shorter one is
    filled with NULL. Files with line ends inside quotes are read in parallel
    all the same, in spans cut at record starts.
    """
    source = source or _inspect(spark, contract)
    multiline = source.spans is not None
    header = read_table(spark, source.first_file, "csv", multiline=multiline).columns
    if LOAD_DATE in header:
        raise LandingError(f"{contract.name}: the source has a column named {LOAD_DATE}")
    line = ref(_MALFORMED)
    fields = F.from_csv(
        line,
        ", ".join(f"c{i} string" for i in range(len(header) + 1)),
        {"escape": '"', "nullValue": _NO_VALUE},
    )
    if multiline:
        raw = read_records(source.spans).select(F.col("record").alias(_MALFORMED))
        raw = raw.select(line, fields.alias("fields"))
        fields = F.col("fields")
        columns = [fields[f"c{i}"].alias(name) for i, name in enumerate(header)]
        too_long = fields[f"c{len(header)}"].isNotNull()
    else:
        raw = (
            spark.read.options(**CSV_READ_OPTIONS)
            .options(
                # That all headers are alike is known from the inspection; Spark's
                # own check would reject blank and repeated names.
                enforceSchema=True,
                recursiveFileLookup=True,
                nullValue=_NO_VALUE,
                columnNameOfCorruptRecord=_MALFORMED,
            )
            .schema(all_strings([*header, _MALFORMED]))
            .csv(contract.source_path)
        )
        scanned = len(raw.inputFiles())
        if scanned != source.files:
            raise LandingError(
                f"{contract.name}: {source.files} files were listed, {scanned} would be read"
            )
        columns = [ref(c) for c in header]
        too_long = line.isNotNull() & fields[f"c{len(header)}"].isNotNull()
    complaint = F.raise_error(
        F.concat(F.lit(f"{contract.name}: row has more than {len(header)} fields: "), line)
    )
    first = F.when(too_long, complaint).otherwise(columns[0]).alias(header[0])
    return raw.select(first, *columns[1:])


def _copy(
    spark: SparkSession, contract: Dataset, load_date: date, source: _Source
) -> tuple[list[str], int]:
    """Write the rows under their load date; returns column names and row count.

    The count comes with the writing tasks themselves. They follow no shuffle,
    so a task that is run again is not counted twice.
    """
    raw = read_raw(spark, contract, source)
    facts = Observation(f"landing {contract.name}")
    (
        raw.observe(facts, F.count(F.lit(1)).alias("rows"))
        .withColumn(LOAD_DATE, F.lit(load_date))
        .write.mode("overwrite")
        .options(**_RAW_WRITE_OPTIONS)
        .partitionBy(LOAD_DATE)
        .csv(contract.bronze_path)
    )
    rows = facts.get["rows"]
    if rows == 0:
        # No row, no partition: leave a file with the header alone.
        empty = spark.createDataFrame([], all_strings(raw.columns)).coalesce(1)
        target = f"{contract.bronze_path}/{LOAD_DATE}={load_date.isoformat()}"
        empty.write.mode("overwrite").options(**_RAW_WRITE_OPTIONS).csv(target)
    return raw.columns, rows


def _keep(
    spark: SparkSession, contract: Dataset, load_date: date, source: _Source, run_id: str
) -> tuple[list[str], int]:
    """Copy the files under their load date as they are; returns column names and row count.

    All rows are parsed before that, for their number and because rows with too
    many fields fail here too. The copies are complete beside the day's folder
    before they take its place, and have the checksum of the inspection.
    """
    raw = read_raw(spark, contract, source)
    facts = Observation(f"landing {contract.name}")
    raw.observe(facts, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("append").save()
    incoming = f"{contract.bronze_path}/_incoming-{run_id}"
    day = f"{contract.bronze_path}/{LOAD_DATE}={load_date.isoformat()}"
    try:
        listed = list_sources(spark, {contract.name: contract.source_path})
        copied = copy_files(listed, incoming).agg(
            F.count(F.lit(1)).alias("files"),
            F.count_distinct("target").alias("targets"),
            F.sum("file_size_bytes").alias("size"),
            combined_md5(F.when(F.col("file_size_bytes") > 0, F.col("checksum"))).alias("checksum"),
        )
        found = copied.first()
        if found["files"] != found["targets"]:
            raise LandingError(f"{contract.name}: two files would bear one name")
        if (found["size"], found["checksum"]) != (source.size, source.checksum):
            raise LandingError(f"{contract.name}: the source has changed while it was landed")
        drop_path(spark, day)
        move_path(spark, incoming, day)
    finally:
        drop_path(spark, incoming)
    return raw.columns, facts.get["rows"]


def land(
    spark: SparkSession,
    contract: Dataset,
    logs: Logs,
    clock: Callable[[], datetime] = utc_now,
) -> LandedRun:
    """Land one dataset's source under today's load date and log the attempt.

    Landing again on the same day replaces that day's rows. Every attempt
    leaves an audit row; a failed one is raised again after that. A metadata
    row that breaks a rule of the log is not written and fails the attempt.
    """
    started = clock()
    load_date = started.astimezone(UTC).date()
    run_id = new_run_id(contract.name, started)
    file_name = contract.source_path.rstrip("/").rsplit("/", 1)[-1]

    def audit(status: str, records: int, message: str | None = None) -> None:
        ended = clock()
        record = {
            "run_id": run_id,
            "dataset_name": contract.name,
            "start_time": started,
            "end_time": ended,
            # A clock that was set back gives no negative duration.
            "duration_seconds": max(0, int((ended - started).total_seconds())),
            "status": status,
            "records_processed": records,
            "file_name": file_name,
            "error_message": message,
        }
        append_record(spark, record, logs.audit, AUDIT_SCHEMA, audit_rules())

    try:
        if contract.file_format.strip().lower() != "csv":
            raise LandingError(f"{contract.name}: only CSV sources are landed")
        source = _inspect(spark, contract)
        try:
            if contract.keep_files:
                columns, rows = _keep(spark, contract, load_date, source, run_id)
            else:
                columns, rows = _copy(spark, contract, load_date, source)
        finally:
            if source.scratch:
                drop_path(spark, source.scratch)
        record = {
            "dataset_name": contract.name,
            "source_file_name": file_name,
            "source_file_path": contract.source_path,
            "file_size_bytes": source.size,
            "row_count": rows,
            "column_count": len(columns),
            "column_names": ",".join(columns),
            "load_date": load_date,
            "ingestion_timestamp": clock(),
            "checksum": source.checksum,
            "run_id": run_id,
        }
        rules = metadata_rules([contract.name])
        append_record(spark, record, logs.metadata, METADATA_SCHEMA, rules)
        audit(SUCCESS, rows)
    except Exception as exc:
        audit(FAILED, 0, str(exc))
        raise
    return LandedRun(run_id, contract.name, load_date, rows, source.checksum)


def land_all(
    spark: SparkSession,
    registry: Mapping[str, Dataset],
    logs: Logs,
    names: str | Iterable[str] = "all",
    parallel: int = 4,
    clock: Callable[[], datetime] = utc_now,
) -> RunSummary:
    """Land several datasets; one that fails does not stop the others.

    Up to `parallel` datasets are in work at once, each in a scheduler pool of
    its own. Where the session shares tasks fairly among pools, as one of
    `get_session` does, small tables do not wait for the tasks of a large one;
    without that the stages of one wait for those that came before. An unknown
    name raises before anything is landed.
    """
    chosen = select_datasets(registry, names)

    def attempt(contract: Dataset) -> str | None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"landing {contract.name}")
        try:
            land(spark, contract, logs, clock)
        except Exception as exc:
            return str(exc)
        return None

    # Wrapped one by one: a wrapped function's threads share their local properties.
    targets = [inheritable_thread_target(spark)(attempt) for _ in chosen]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        messages = list(pool.map(lambda run, contract: run(contract), targets, chosen))
    outcome = list(zip([c.name for c in chosen], messages, strict=True))
    return RunSummary(
        succeeded=[name for name, message in outcome if message is None],
        failed={name: message for name, message in outcome if message is not None},
    )
