"""The registered queries: every operator on the test tables, whole.

A query that needs files of another form (CSV sources, load-date folders)
derives them from the tables, below the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import fixtures as fx
from millrace.contracts import Dataset, ForeignKey, struct
from millrace.errors import QualityError
from millrace.functions.casts import lenient_cast
from millrace.functions.runs import duration_seconds, load_date, run_id
from millrace.operators import cleaning, dedup, logrules, profiles, quality, references, schema
from millrace.plans import landing, reports, silver
from millrace.plans.transform import transform
from millrace.session import path_exists, scratch_path
from millrace.sinks import logs, tables
from millrace.sources import csv_ranges, files, listing, readers
from millrace.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# One instant for all landing queries, so that their logs are reproducible.
RUN_TIME = datetime(2026, 1, 31, 23, 59, 58, tzinfo=UTC)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.read_table(spark, f"{sf_dir}/{name}.parquet", "parquet")


def export_csv(df: DataFrame, path: str, *partition_columns: str) -> str:
    """Write a table as the CSV source that a landing or a scan starts from."""
    writer = df.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.csv(path)
    return path


# Scans


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


@query
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = export_csv(table(spark, sf_dir, "lineitem"), scratch_path(spark, "scan-csv"))
    raw = readers.read_table(spark, path, "csv")
    return schema.enforce_schema(raw, fx.LINEITEM.schema, "lineitem")


@query
def csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = export_csv(table(spark, sf_dir, "documents"), scratch_path(spark, "quoted"))
    raw = readers.read_table(spark, path, " CSV ", multiline=True)
    return schema.enforce_schema(raw, fx.DOCUMENTS.schema, "documents")


@query
def csv_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five first customers by key, off a CSV file."""
    path = export_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "peek"))
    raw = readers.read_table(spark, path, "csv")
    typed = schema.enforce_schema(raw, fx.CUSTOMER.schema, "customer")
    return readers.peek(typed.orderBy("c_custkey"), 5)


def _orders_by_year(spark: SparkSession, sf_dir: str) -> Dataset:
    """Orders landed as CSV, each under the first day of its year."""
    year = F.to_date(F.date_trunc("year", "o_orderdate"))
    orders = table(spark, sf_dir, "orders").withColumn("load_date", year)
    path = export_csv(orders, scratch_path(spark, "bronze-orders"), "load_date")
    return replace(fx.ORDERS, bronze_path=path)


@query
def replay_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = _orders_by_year(spark, sf_dir)
    chosen = readers.read_bronze(spark, contract, [date(1998, 1, 1), date(1996, 1, 1)])
    return schema.enforce_schema(chosen, contract.schema, contract.name)


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = _orders_by_year(spark, sf_dir)
    newest = readers.read_bronze(spark, contract, "latest")
    return schema.enforce_schema(newest, contract.schema, contract.name)


@query
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.file_manifest(spark, sf_dir, "*.parquet")


@query
def block_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.block_manifest(spark, sf_dir, "*.parquet", block_bytes=1 << 18)


@query
def content_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What identifies a table's rows, before and after they have been landed."""
    root = scratch_path(spark, "digests")
    parts = []
    for name, columns in fx.PLAIN_COLUMNS.items():
        rows = table(spark, sf_dir, name).select(*columns)
        parts.append(profiles.content_digest(rows, name))
        contract = replace(fx.RELATIONAL[name], schema=rows.schema)
        landed = _landed(spark, contract, export_csv(rows, f"{root}/{name}.csv"), f"{root}/{name}")
        parts.append(profiles.content_digest(landed, f"landed {name}"))
    return reduce(DataFrame.union, parts)


@query
def source_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is there a file of indebted suppliers for each nation?"""
    indebted = table(spark, sf_dir, "supplier").where("s_acctbal < 0")
    path = export_csv(indebted, scratch_path(spark, "by-nation"), "s_nationkey")
    # From the path rather than as a partition column: there may be no file at all.
    nation = F.regexp_extract("path", "s_nationkey=([0-9]+)", 1).try_cast("int")
    found = files.list_files(spark, path).select(
        nation.alias("n_nationkey"), F.col("file_size_bytes").alias("length")
    )
    return files.check_sources(table(spark, sf_dir, "nation"), found, "n_nationkey")


@query
def source_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's file of indebted suppliers: there, without a byte, or not there."""
    root = scratch_path(spark, "verdicts")
    export_csv(table(spark, sf_dir, "supplier").where("s_acctbal < 0"), root, "s_nationkey")
    nations = table(spark, sf_dir, "nation")
    # A file without a byte for all nations of one region that have none.
    blank = spark.createDataFrame([], "value string").coalesce(1)
    sources = {}
    for row in nations.select("n_nationkey", "n_regionkey").collect():
        path = f"{root}/s_nationkey={row.n_nationkey}"
        if row.n_regionkey == 1 and not path_exists(spark, path):
            blank.write.text(path)
        sources[str(row.n_nationkey)] = path
    found = listing.source_verdicts(listing.list_sources(spark, sources))
    return found.select(F.col("source").cast("int").alias("n_nationkey"), "verdict")


@query
def csv_records_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read from CSV files that are cut inside quoted text as often as not."""
    source = export_csv(table(spark, sf_dir, "documents"), scratch_path(spark, "ranges"))
    raw = csv_ranges.read_csv_in_ranges(spark, source, range_bytes=1 << 16)
    return schema.enforce_schema(raw, fx.DOCUMENTS.schema, "documents")


# Schema, casts, names


@query
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.table_profiles({n: table(spark, sf_dir, n) for n in fx.TABLES})


@query
def enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = fx.LINEITEM_WHOLE_NUMBERS
    lines = table(spark, sf_dir, "lineitem")
    return schema.enforce_schema(lines, contract.schema, contract.name)


def _odd_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text in seven spellings, some of them no whole number."""
    text = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("  "), "l_orderkey", F.lit(" ")))
        .when(F.col("l_linenumber") == 2, F.col("l_quantity").cast("string"))
        .when(F.col("l_linenumber") == 3, F.concat(F.lit("+"), "l_partkey"))
        .when(F.col("l_linenumber") == 4, F.concat(F.lit("-"), "l_suppkey", F.lit(".")))
        .when(F.col("l_linenumber") == 5, F.concat("l_orderkey", F.lit("e3")))
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("."), "l_partkey"))
        .when(F.col("l_returnflag") == "A", F.concat("l_returnflag", "l_partkey"))
        .when(F.col("l_returnflag") == "N", F.concat("l_suppkey", F.lit("0000000000")))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("t"))


@query
def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd_numbers(spark, sf_dir).select(
        "*",
        lenient_cast(F.col("t"), T.StringType(), T.IntegerType()).alias("as_int"),
        lenient_cast(F.col("t"), T.StringType(), T.DoubleType()).alias("as_double"),
    )


@query
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = struct(("l_orderkey", T.IntegerType(), False), ("t", T.IntegerType(), True))
    return schema.cast_failures(_odd_numbers(spark, sf_dir), target, "odd_numbers")


def _padded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumns(
        {
            "c_name": F.concat(F.lit("  "), "c_name", F.lit(" ")),
            "c_mktsegment": F.concat(F.lit("\t"), "c_mktsegment", F.lit("\u00a0  ")),
        }
    )


@query
def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.trim_strings(_padded_customers(spark, sf_dir))


@query
def standard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    spaced = customers.toDF("Customer Key", "C NAME", "c_nationkey", "Acct.Bal", "Mkt  Segment")
    return cleaning.standardize_names(spaced)


# Deduplication and the conforming chain


@query
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_by_key(table(spark, sf_dir, "lineitem"), fx.LINEITEM.primary_key)


@query
def dedup_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's latest order."""
    return dedup.dedup_by_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"])


def _net_price(df: DataFrame, contract: Dataset) -> DataFrame:
    return df.withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query
def transform_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    padded = lines.withColumn("l_returnflag", F.concat(F.lit(" "), "l_returnflag"))
    padded = padded.withColumnRenamed("l_returnflag", "L ReturnFlag")
    return transform(padded, fx.LINEITEM, hooks={"lineitem": _net_price})


# Quality


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count(table(spark, sf_dir, "lineitem"))


def _gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with NULLs in two columns and in part of the keys."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").select(
        F.when(~(urgent & (F.col("o_orderstatus") == "P")), F.col("o_orderkey")).alias("o_orderkey"),
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        "o_orderdate",
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"),
    )


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    gappy = _gappy_orders(spark, sf_dir)
    return quality.null_counts(gappy, gappy.columns)


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), fx.LINEITEM.primary_key)


@query
def surplus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.surplus_rows(table(spark, sf_dir, "lineitem"), fx.LINEITEM.primary_key)


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = replace(
        fx.ORDERS,
        primary_key=("o_orderkey", "o_custkey", "o_clerk"),
        required=("o_orderstatus", "o_orderpriority", "o_custkey", "o_comment"),
    )
    return quality.quality_checks(_gappy_orders(spark, sf_dir), contract)


@query
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table that passes the gate; computed once, then checked, then read."""
    lines = dedup_by_key(spark, sf_dir)
    return silver.gated(lines, fx.LINEITEM, scratch_path(spark, "gated"))[0]


@query
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without lines."""
    link = ForeignKey(("o_orderkey",), "lineitem", ("l_orderkey",))
    return references.orphan_rows(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), link
    )


@query
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts sold although no part of that key is larger than 25."""
    link = ForeignKey(("l_partkey",), "part", ("p_partkey",))
    large_parts = table(spark, sf_dir, "part").where("p_size > 25")
    return references.orphan_keys(table(spark, sf_dir, "lineitem"), large_parts, link)


@query
def reference_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    broken = lines.withColumns(
        {
            "l_orderkey": F.when(F.col("l_returnflag") == "R", -F.col("l_orderkey") - 1).otherwise(
                F.col("l_orderkey")
            ),
            "l_suppkey": F.when(F.col("l_linestatus") == "O", F.col("l_suppkey")),
        }
    )
    parents = {n: table(spark, sf_dir, n) for n in ("orders", "part", "supplier")}
    return references.reference_report(broken, fx.LINEITEM, parents)


# Landing and logs


def _land_tables(spark: SparkSession, sf_dir: str) -> landing.Logs:
    """Export the relational tables, land them all plus one that is missing."""
    root = scratch_path(spark, "landing")
    registry = {}
    for name, contract in fx.RELATIONAL.items():
        source = export_csv(table(spark, sf_dir, name), f"{root}/source/{name}.csv")
        registry[name] = replace(
            contract, source_path=source, bronze_path=f"{root}/bronze/{name}"
        )
    registry["absent"] = replace(
        fx.REGION,
        name="absent",
        source_path=f"{root}/source/absent.csv",
        bronze_path=f"{root}/bronze/absent",
    )
    where = landing.Logs(f"{root}/metadata", f"{root}/audit")
    landing.land_all(spark, registry, where, clock=lambda: RUN_TIME)
    return where


@query
def landing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _land_tables(spark, sf_dir)
    return logs.read_log(spark, where.metadata, logs.METADATA_SCHEMA).select(
        "dataset_name",
        "source_file_name",
        "row_count",
        "column_count",
        "column_names",
        "load_date",
        F.unix_seconds("ingestion_timestamp").alias("ingested_at"),
        "run_id",
    )


@query
def landing_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and MD5 that landing logs for single-file sources."""
    root = scratch_path(spark, "checksums")
    where = landing.Logs(f"{root}/metadata", f"{root}/audit")
    for name, columns in fx.PLAIN_COLUMNS.items():
        rows = table(spark, sf_dir, name).select(*columns).orderBy(columns[0]).coalesce(1)
        source = export_csv(rows, f"{root}/source/{name}.csv")
        contract = replace(fx.RELATIONAL[name], source_path=source, bronze_path=f"{root}/{name}")
        landing.land(spark, contract, where, clock=lambda: RUN_TIME)
    log = logs.read_log(spark, where.metadata, logs.METADATA_SCHEMA)
    return log.select("dataset_name", "file_size_bytes", "checksum")


@query
def landing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _land_tables(spark, sf_dir)
    return logs.read_log(spark, where.audit, logs.AUDIT_SCHEMA).select(
        "run_id",
        "dataset_name",
        "duration_seconds",
        "status",
        "records_processed",
        "file_name",
        F.col("error_message").isNotNull().alias("has_message"),
    )


@query
def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a whole landing, read back from bronze."""
    root = scratch_path(spark, "landed")
    contract = replace(
        fx.DOCUMENTS,
        source_path=export_csv(table(spark, sf_dir, "documents"), f"{root}/documents.csv"),
        bronze_path=f"{root}/bronze",
    )
    where = landing.Logs(f"{root}/metadata", f"{root}/audit")
    landing.land(spark, contract, where, clock=lambda: RUN_TIME)
    bronze = readers.read_bronze(spark, contract)
    return schema.enforce_schema(bronze, contract.schema, contract.name, keep=["load_date"])


def _landed(spark: SparkSession, contract: Dataset, source: str, root: str) -> DataFrame:
    contract = replace(contract, source_path=source, bronze_path=f"{root}/bronze")
    where = landing.Logs(f"{root}/metadata", f"{root}/audit")
    landing.land(spark, contract, where, clock=lambda: RUN_TIME)
    bronze = readers.read_bronze(spark, contract)
    return schema.enforce_schema(bronze, contract.schema, contract.name)


@query
def landed_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers landed from a source whose files lie in folders of unlike depth."""
    root = scratch_path(spark, "nested")
    suppliers = table(spark, sf_dir, "supplier")
    indebted = F.coalesce(F.col("s_acctbal") < 0, F.lit(False))
    export_csv(suppliers.where(indebted), f"{root}/source/indebted/files")
    export_csv(suppliers.where(~indebted), f"{root}/source/others")
    return _landed(spark, fx.RELATIONAL["supplier"], f"{root}/source", root)


@query
def landed_inch_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose names hold a quote that quotes nothing, landed from files without any quoting."""
    root = scratch_path(spark, "inches")
    parts = table(spark, sf_dir, "part")
    named = F.concat("p_name", F.lit(' '), "p_size", F.lit('" wide'))
    source = f"{root}/part.csv"
    parts.withColumn("p_name", named).write.options(header=True, quote="").csv(source)
    return _landed(spark, fx.RELATIONAL["part"], source, root)


@query
def landed_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with line ends inside quotes, landed from ranges of their files."""
    root = scratch_path(spark, "multiline")
    broken = F.concat(F.lit('say ""'), "lang", F.lit('"\n'), "text", F.lit("\r\n"))
    documents = table(spark, sf_dir, "documents").withColumn("text", broken)
    source = export_csv(documents, f"{root}/documents.csv")
    return _landed(spark, replace(fx.DOCUMENTS, multiline=True), source, root)


@query
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and MD5 of source files of orders, one per priority, after they were landed as received."""
    root = scratch_path(spark, "kept")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    orders = orders.repartition("o_orderpriority").sortWithinPartitions("o_orderpriority", "o_orderkey")
    source = export_csv(orders, f"{root}/source", "o_orderpriority")
    contract = replace(
        fx.ORDERS, source_path=source, bronze_path=f"{root}/bronze", keep_files=True
    )
    where = landing.Logs(f"{root}/metadata", f"{root}/audit")
    landing.land(spark, contract, where, clock=lambda: RUN_TIME)
    priority = F.regexp_extract("file_name", "^o_orderpriority=(.*)__", 1)
    found = files.file_manifest(spark, contract.bronze_path)
    return found.select(priority.alias("o_orderpriority"), "file_size_bytes", "checksum")


@query
def packed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log of several landings after its folders were packed into one file."""
    where = _land_tables(spark, sf_dir)
    for _ in range(2):
        logs.pack_log(
            spark, where.audit, logs.AUDIT_SCHEMA, F.to_date("start_time"), date(2026, 2, 1)
        )
    log = logs.read_log(spark, where.audit, logs.AUDIT_SCHEMA)
    return log.select("run_id", "dataset_name", "status", "records_processed", "file_name")


@query
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a run: its identifier, load date and duration."""
    started = F.col("ts").cast("timestamp_ntz")
    ended = started + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        run_id(F.col("event_type"), started).alias("run_id"),
        load_date(started).alias("load_date"),
        duration_seconds(started, ended).alias("duration_seconds"),
    )


def _document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of the metadata log, some rows against the rules."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset_name"),
        F.when(F.col("lang") != "de", F.concat(F.lit("doc"), "doc_id")).alias("source_file_name"),
        F.col("n_chars").alias("file_size_bytes"),
        (F.col("n_chars") - 60).alias("row_count"),
        (F.length("lang") - F.when(F.col("lang") == "es", 2).otherwise(0)).alias("column_count"),
        F.when(F.col("n_chars") < 100, F.lit(date(2026, 1, 31))).alias("load_date"),
        F.lit(datetime(2026, 1, 31, 12)).cast("timestamp").alias("ingestion_timestamp"),
        F.when(F.col("lang") != "fr", F.md5("text")).alias("checksum"),
        F.concat_ws("_", "source", "doc_id").alias("run_id"),
    )


@query
def metadata_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = logrules.metadata_rules(["src0", "src1", "src2", "src3"])
    return logrules.violations(_document_log(spark, sf_dir), rules, ["run_id"])


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of the audit log, some rows against the rules."""
    status = (
        F.when(F.col("event_type").isin("view", "click"), logs.SUCCESS)
        .when(F.col("event_type").isin("error", "signup"), logs.FAILED)
        .otherwise(F.upper("event_type"))
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws("_", "event_type", "event_id").alias("run_id"),
        F.concat(F.lit("user"), "user_id").alias("dataset_name"),
        F.col("ts").alias("start_time"),
        F.floor(F.col("value") - 1).cast("int").alias("duration_seconds"),
        status.alias("status"),
        F.when(F.col("value") < 150, F.col("props")).alias("file_name"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
    )


@query
def audit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logrules.violations(_event_log(spark, sf_dir), logrules.audit_rules(), ["run_id"])


@query
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_totals(_event_log(spark, sf_dir))


@query
def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_outcomes(_event_log(spark, sf_dir))


@query
def duplicate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    checksums = table(spark, sf_dir, "documents").select(F.md5("text").alias("checksum"))
    return reports.duplicate_loads(checksums, by=["checksum"])


@query
def already_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the last sources whose text the other sources brought before."""
    documents = table(spark, sf_dir, "documents")
    checksummed = documents.select("doc_id", "source", F.md5("text").alias("checksum"))
    log = checksummed.where("source < 'src15'")
    manifest = checksummed.where("source >= 'src15'")
    return reports.already_loaded(manifest, log)


@query
def combined_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two logs of unlike columns as one."""
    documents = _document_log(spark, sf_dir).select("run_id", "dataset_name", "row_count")
    events = _event_log(spark, sf_dir).select("run_id", "status", "dataset_name")
    return logs.combine_logs(documents, events)


# Publishing


@query
def publish_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions that come again are replaced, the others stay."""
    path = scratch_path(spark, "published")
    orders = table(spark, sf_dir, "orders")
    tables.write_table(orders, path, partition_columns=["o_orderpriority"])
    again = orders.where("o_orderpriority = '2-HIGH' and o_orderstatus <> 'F'")
    again = again.withColumn("o_totalprice", F.lit(0.0))
    tables.write_table(again, path, partition_columns=["o_orderpriority"])
    return spark.read.parquet(path).select(*orders.columns)


def _order_changes(orders: DataFrame) -> DataFrame:
    """Open orders at a new price, and one new order for each order that is pending."""
    repriced = orders.where("o_orderstatus = 'O'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    pending = orders.where("o_orderstatus = 'P'")
    return repriced.unionByName(pending.withColumn("o_orderkey", -F.col("o_orderkey") - 1))


def _upserted(spark: SparkSession, sf_dir: str, *partition_columns: str) -> DataFrame:
    path = scratch_path(spark, "upserted")
    orders = table(spark, sf_dir, "orders")
    options = {"partition_columns": partition_columns, "key": fx.ORDERS.primary_key}
    tables.write_table(orders, path, **options)
    tables.write_table(_order_changes(orders), path, mode="merge", **options)
    return spark.read.parquet(path).select(*orders.columns)


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is replaced through staging."""
    return _upserted(spark, sf_dir)


@query
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only partitions with changes are replaced."""
    return _upserted(spark, sf_dir, "o_orderstatus")


@query
def silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines landed as text in two loads, brought to one clean row per key and published."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_returnflag", F.concat(F.lit(" "), "l_returnflag", F.lit("  "))
    )
    first = lines.withColumn("load_date", F.lit(date(2026, 1, 30)))
    second = lines.where("l_linestatus = 'O'").withColumns(
        {"load_date": F.lit(date(2026, 1, 31)), "l_tax": F.col("l_tax") + 1}
    )
    root = scratch_path(spark, "silver")
    bronze = export_csv(first.unionByName(second), f"{root}/bronze", "load_date")
    contract = replace(
        fx.LINEITEM,
        bronze_path=bronze,
        silver_path=f"{root}/silver",
        partition_columns=("l_linestatus",),
    )
    silver.run_silver(spark, contract)
    return spark.read.parquet(contract.silver_path).select(*contract.schema.names)


@query
def gate_with_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published orders, which a second load with orphans does not get past the gate to replace."""
    contract = replace(fx.ORDERS, silver_path=f"{scratch_path(spark, 'references')}/silver")
    orders = table(spark, sf_dir, "orders")
    parents = {"customer": table(spark, sf_dir, "customer")}
    silver.conform_and_publish(orders, contract, parents=parents)
    broken = F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey") - 1)
    broken = orders.withColumn("o_custkey", broken.otherwise(F.col("o_custkey")))
    try:
        silver.conform_and_publish(broken, contract, parents=parents)
    except QualityError:
        pass
    return spark.read.schema(orders.schema).parquet(contract.silver_path)


@query
def silver_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event, after the older load date has been replayed onto the newer one."""
    root = scratch_path(spark, "backfill")
    contract = replace(
        fx.EVENTS,
        primary_key=("user_id",),
        version=("ts",),
        bronze_path=f"{root}/bronze",
        silver_path=f"{root}/silver",
        file_format="parquet",
        write_mode="merge",
    )
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.agg(F.percentile_approx(micros, 0.5)).first()[0]
    day = F.when(micros >= middle, F.lit(date(2026, 1, 31))).otherwise(F.lit(date(2026, 1, 30)))
    events.withColumn("load_date", day).write.partitionBy("load_date").parquet(contract.bronze_path)
    silver.run_silver(spark, contract, "latest")
    silver.run_silver(spark, contract, [date(2026, 1, 30)])
    return spark.read.parquet(contract.silver_path)


# Incremental loads


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream takes a folder or a pattern, not a single file.
    return incremental.read_new_files(spark, f"{sf_dir}/events.parquet*", fx.EVENTS.schema)


@query
def incremental_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same folder land every event once."""
    root = scratch_path(spark, "stream")
    day = F.to_date("ts")
    for _ in range(2):
        stream = _event_stream(spark, sf_dir)
        incremental.land_new_files(stream, f"{root}/bronze", f"{root}/checkpoint", day)
    return spark.read.parquet(f"{root}/bronze").select(*fx.EVENTS.schema.names, "load_date")


@query
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event, kept up to date from new files; the older half comes last."""
    root = scratch_path(spark, "stream-merge")
    contract = replace(
        fx.EVENTS,
        primary_key=("user_id",),
        version=("ts",),
        silver_path=f"{root}/silver",
        write_mode="merge",
    )
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.agg(F.percentile_approx(micros, 0.5)).first()[0]
    newer = micros >= middle
    for name, part in (("newer", events.where(newer)), ("older", events.where(~newer))):
        part.write.parquet(f"{root}/{name}")
        stream = incremental.read_new_files(spark, f"{root}/{name}", events.schema)
        incremental.merge_new_files(stream, contract, f"{root}/checkpoint-{name}")
    return spark.read.parquet(contract.silver_path)


@query
def incremental_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed once each by two runs, the second of which brings those of the first again.

    What only the second brings is late where it is a day older than what the first has.
    """
    root = scratch_path(spark, "unique")
    events = table(spark, sf_dir, "events")
    for number, part in enumerate((events.where("event_type <> 'error'"), events)):
        part.write.parquet(f"{root}/source/{number}")
        stream = incremental.read_new_files(spark, f"{root}/source/*", fx.EVENTS.schema)
        incremental.land_unique_new_files(
            stream, f"{root}/bronze", f"{root}/checkpoint", ["event_id"], "ts", spread=4
        )
    both = incremental.landed(spark, f"{root}/bronze", late=None)
    return both.select(*fx.EVENTS.schema.names, "load_date", "late")


def _order_stream(spark: SparkSession, orders: DataFrame, path: str) -> DataFrame:
    orders.write.parquet(path)
    return incremental.read_new_files(spark, path, orders.schema)


@query
def incremental_gate_with_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published by a stream; a second one with orphans stops before it publishes any."""
    root = scratch_path(spark, "stream-references")
    contract = replace(fx.ORDERS, silver_path=f"{root}/silver", write_mode="merge")
    orders = table(spark, sf_dir, "orders")
    parents = {"customer": table(spark, sf_dir, "customer")}
    broken = F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey") - 1)
    broken = orders.withColumn("o_custkey", broken.otherwise(F.col("o_custkey")))
    for number, part in enumerate((orders, broken)):
        stream = _order_stream(spark, part, f"{root}/source-{number}")
        try:
            incremental.merge_new_files(
                stream, contract, f"{root}/checkpoint-{number}", parents=parents
            )
        except StreamingQueryException:
            pass
    return spark.read.schema(orders.schema).parquet(contract.silver_path)


@query
def incremental_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by whether they are published: some wait for customers of which a part comes later."""
    root = scratch_path(spark, "stream-orphans")
    contract = replace(
        fx.ORDERS, silver_path=f"{root}/silver", write_mode="merge", version=("o_orderdate",)
    )
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    solvent = {"customer": customers.where("c_acctbal >= 0")}
    stream = _order_stream(spark, orders, f"{root}/source")
    aside = f"{root}/orphans"
    incremental.merge_new_files(
        stream, contract, f"{root}/checkpoint", parents=solvent, orphans_path=aside
    )
    more = {"customer": customers.where("c_acctbal >= 0 or c_mktsegment = 'BUILDING'")}
    incremental.release_orphans(spark, contract, aside, more)
    states = {"published": contract.silver_path, "waiting": aside}
    parts = [
        spark.read.parquet(path).select("o_orderkey", F.lit(state).alias("state"))
        for state, path in states.items()
    ]
    return parts[0].union(parts[1])


@query
def upsert_moved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status after all orders of one status have moved to another one."""
    path = scratch_path(spark, "moved")
    orders = table(spark, sf_dir, "orders")
    options = {"partition_columns": ["o_orderstatus"], "key": ["o_orderkey"]}
    tables.write_table(orders, path, **options)
    changes = orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("F"))
    tables.write_table(changes, path, mode="merge", **options)
    return spark.read.schema(orders.schema).parquet(path)


@query
def silver_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table published whole twice; the second time one partition has no rows."""
    root = scratch_path(spark, "republished")
    contract = replace(
        fx.ORDERS, silver_path=f"{root}/silver", partition_columns=("o_orderstatus",)
    )
    orders = table(spark, sf_dir, "orders")
    silver.conform_and_publish(orders, contract)
    moved = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus"))
    silver.conform_and_publish(orders.withColumn("o_orderstatus", moved), contract)
    return spark.read.schema(orders.schema).parquet(contract.silver_path)
