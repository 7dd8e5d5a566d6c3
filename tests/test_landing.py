from __future__ import annotations

import hashlib
import json
import random
import subprocess
import sys
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Dataset, lookup, retail_datasets, select_datasets, struct
from millrace.errors import ContractError, LandingError
from millrace.functions.digests import combined_md5
from millrace.functions.runs import duration_seconds, new_run_id, run_id
from millrace.operators.logrules import audit_rules, metadata_rules, violations
from millrace.operators.profiles import content_digest
from millrace.plans import landing
from millrace.plans.landing import Logs, land, land_all, read_raw
from millrace.plans.reports import already_loaded, duplicate_loads, run_outcomes, run_totals
from millrace.sinks.logs import (
    AUDIT_SCHEMA,
    METADATA_SCHEMA,
    append_record,
    combine_logs,
    pack_log,
    read_log,
)
from millrace.sources import csv_ranges
from millrace.sources.files import block_manifest, check_sources, file_manifest
from millrace.sources.readers import read_bronze

SCHEMA = struct(
    ("id", T.IntegerType(), False), ("name", T.StringType(), True), ("v", T.IntegerType(), True)
)
GOOD = 'id,name,v\n1," pad ",2\n2,,3\n3,"",4\n4,x\n5,"say ""hi"", x",\n'


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Clock:
    """Moves on by 1.7 seconds at each look."""

    def __init__(self, now=datetime(2026, 1, 31, 23, 59, 58, tzinfo=UTC)):
        self.now = now

    def __call__(self):
        self.now += timedelta(seconds=1.7)
        return self.now


@pytest.fixture
def lake(root):
    def make(name: str, text: str | None, **more) -> Dataset:
        if text is not None:
            Path(f"{root}/{name}.csv").write_text(text)
        return Dataset(
            name,
            SCHEMA,
            primary_key=("id",),
            source_path=f"{root}/{name}.csv",
            bronze_path=f"{root}/bronze/{name}",
            **more,
        )

    make.logs = Logs(f"{root}/metadata", f"{root}/audit")
    return make


def audit(spark, lake):
    return read_log(spark, lake.logs.audit, AUDIT_SCHEMA).orderBy("start_time").collect()


def metadata(spark, lake):
    return read_log(spark, lake.logs.metadata, METADATA_SCHEMA).collect()


def test_landing_keeps_values_and_logs_the_run(spark, lake):
    contract = lake("things", GOOD)
    run = land(spark, contract, lake.logs, Clock())
    # The load date is that of the start, although the run ends after midnight.
    assert (run.row_count, run.load_date) == (5, date(2026, 1, 31))
    [landed] = Path(contract.bronze_path).glob("load_date=2026-01-31/*.csv")
    assert landed.read_text() == 'id,name,v\n1, pad ,2\n2,,3\n3,"",4\n4,x,\n5,"say ""hi"", x",\n'
    [row] = metadata(spark, lake)
    assert row.asDict() | {"ingestion_timestamp": None} == {
        "dataset_name": "things",
        "source_file_name": "things.csv",
        "source_file_path": contract.source_path,
        "file_size_bytes": len(GOOD),
        "row_count": 5,
        "column_count": 3,
        "column_names": "id,name,v",
        "load_date": date(2026, 1, 31),
        "ingestion_timestamp": None,
        "checksum": hashlib.md5(GOOD.encode()).hexdigest(),
        "run_id": "things_20260131235959",
    }
    [row] = audit(spark, lake)
    assert (row.status, row.records_processed, row.error_message) == ("SUCCESS", 5, None)
    assert (row.run_id, row.file_name, row.duration_seconds) == (run.run_id, "things.csv", 3)


def test_landing_again_replaces_the_day_and_adds_log_rows(spark, lake):
    contract = lake("things", GOOD)
    clock = Clock()
    land(spark, contract, lake.logs, clock)
    clock.now = datetime(2026, 2, 1, 8, tzinfo=UTC)
    land(spark, contract, lake.logs, clock)
    land(spark, contract, lake.logs, clock)
    bronze = read_bronze(spark, contract)
    assert {r.load_date: r["count"] for r in bronze.groupBy("load_date").count().collect()} == {
        date(2026, 1, 31): 5,
        date(2026, 2, 1): 5,
    }
    assert len(metadata(spark, lake)) == len(audit(spark, lake)) == 3
    loads = duplicate_loads(read_log(spark, lake.logs.metadata, METADATA_SCHEMA)).first()
    assert (loads.dataset_name, loads.loads) == ("things", 3)


def test_latest_and_replayed_load_dates(spark, lake):
    contract = lake("things", GOOD)
    clock = Clock()
    land(spark, contract, lake.logs, clock)
    Path(contract.source_path).write_text("id,name,v\n9,z,9\n")
    clock.now = datetime(2026, 2, 1, 8, tzinfo=UTC)
    land(spark, contract, lake.logs, clock)
    newest = read_bronze(spark, contract, "latest")
    assert [r.id for r in newest.collect()] == ["9"]
    assert "PartitionFilters: [isnotnull(load_date" in plan(newest)
    old = read_bronze(spark, contract, [date(2026, 1, 31)])
    assert old.count() == 5
    assert "PartitionFilters: [isnotnull(load_date" in plan(old)


def test_header_without_rows(spark, lake):
    contract = lake("none", "id,name,v\n")
    clock = Clock()
    assert land(spark, contract, lake.logs, clock).row_count == 0
    empty = read_bronze(spark, contract)
    assert empty.count() == 0 and empty.columns == ["id", "name", "v", "load_date"]


@pytest.mark.parametrize(
    "text, message",
    [
        (None, "source is missing"),
        ("", "source is empty"),
        ("id,name,v\n1,a,2\n2,,,77\n", "row has more than 3 fields: 2,,,77"),
        ("id,load_date\n1,2\n", "has a column named load_date"),
    ],
)
def test_failed_landing_is_logged_and_raised(spark, lake, text, message):
    contract = lake("bad", text)
    with pytest.raises(Exception, match=message):
        land(spark, contract, lake.logs, Clock())
    [row] = audit(spark, lake)
    assert (row.status, row.records_processed) == ("FAILED", 0)
    assert message in row.error_message
    assert not Path(lake.logs.metadata).exists()
    assert not list(Path(contract.bronze_path).rglob("*.csv"))


def test_failed_landing_keeps_what_was_there(spark, lake):
    contract = lake("things", GOOD)
    clock = Clock()
    land(spark, contract, lake.logs, clock)
    Path(contract.source_path).write_text("id,name,v\n1,2,3,4\n")
    clock.now -= timedelta(hours=1)
    with pytest.raises(Exception, match="more than 3"):
        land(spark, contract, lake.logs, clock)
    assert read_bronze(spark, contract).count() == 5


def test_only_csv_is_landed(spark, lake):
    with pytest.raises(LandingError, match="only CSV"):
        land(spark, lake("p", GOOD, file_format="parquet"), lake.logs, Clock())


def test_blank_and_repeated_header_names(spark, lake):
    contract = lake("odd", ",a,a\n1,2,3\n")
    assert [tuple(r) for r in read_raw(spark, contract).collect()] == [("1", "2", "3")]
    land(spark, contract, lake.logs, Clock())
    assert metadata(spark, lake)[0].column_count == 3


def test_line_breaks_in_quotes(spark, lake):
    contract = lake("text", 'id,name,v\n1,"two\nlines, and ""more""",3\n', multiline=True)
    assert land(spark, contract, lake.logs, Clock()).row_count == 1
    assert read_bronze(spark, contract).first().name == 'two\nlines, and "more"'


def test_source_folder_with_unlike_headers_fails(spark, lake, root):
    contract = lake("folder", None)
    Path(contract.source_path).mkdir()
    Path(f"{contract.source_path}/1.csv").write_text("id,name,v\n1,a,2\n")
    Path(f"{contract.source_path}/2.csv").write_text("id,name,v\n2,b,3\n")
    run = land(spark, contract, lake.logs, Clock())
    assert run.row_count == 2
    Path(f"{contract.source_path}/3.csv").write_text("name,id,v\na,1,2\n")
    with pytest.raises(LandingError, match="differ in their headers"):
        land(spark, contract, lake.logs, Clock())


def test_repeated_header_names_land_from_several_files_too(spark, lake):
    contract = lake("twice", None)
    Path(contract.source_path).mkdir()
    for name, header in (("1", "\ufeffid,a,a"), ("2", '"id",A,a\r')):
        Path(f"{contract.source_path}/{name}.csv").write_text(f"{header}\n1,2,3\n")
    assert land(spark, contract, lake.logs, Clock()).row_count == 2


def test_a_log_row_that_breaks_a_rule_is_not_written(spark, lake, monkeypatch):
    contract = lake("things", GOOD)
    monkeypatch.setattr("millrace.plans.landing._copy", lambda *_: ([], -1))
    with pytest.raises(Exception, match="row_count_not_negative, column_count_positive"):
        land(spark, contract, lake.logs, Clock())
    [row] = audit(spark, lake)
    assert row.status == "FAILED" and "column_count_positive" in row.error_message
    assert not list(Path(lake.logs.metadata).rglob("*.parquet"))


@pytest.mark.parametrize(
    ("content", "message"),
    [
        (b'id,name,v\n1,"two\nlines",3\n', "line breaks inside quotes"),
        (b'id,name,v\n1,"open,3\n2,b,4\n', "ends inside quotes"),
        ("id,name,v\n1,caf\u00e9,3\n".encode("latin-1"), "is not UTF-8"),
    ],
)
def test_torn_or_recoded_rows_are_never_a_success(spark, lake, content, message):
    contract = lake("torn", GOOD)
    land(spark, contract, lake.logs, Clock())
    before = sorted(map(tuple, spark.read.csv(contract.bronze_path).collect()), key=str)
    Path(contract.source_path).write_bytes(content)
    with pytest.raises(LandingError, match=message):
        land(spark, contract, lake.logs, Clock())
    assert sorted(map(tuple, spark.read.csv(contract.bronze_path).collect()), key=str) == before
    statuses = [r.status for r in read_log(spark, lake.logs.audit, AUDIT_SCHEMA).collect()]
    assert sorted(statuses) == ["FAILED", "SUCCESS"]


def test_several_datasets(spark, lake):
    registry = {c.name: c for c in (lake("a", GOOD), lake("b", None), lake("c", GOOD))}
    summary = land_all(spark, registry, lake.logs)
    assert summary.succeeded == ["a", "c"] and list(summary.failed) == ["b"]
    assert summary.total == 3 and "missing" in summary.failed["b"]
    log = read_log(spark, lake.logs.audit, AUDIT_SCHEMA)
    assert tuple(run_totals(log).first()) == (3, 2, 1)
    assert {tuple(r) for r in run_outcomes(log).collect()} == {
        ("SUCCESS", "a", 1),
        ("SUCCESS", "c", 1),
        ("FAILED", "b", 1),
    }
    assert land_all(spark, registry, lake.logs, "c").succeeded == ["c"]
    with pytest.raises(ContractError, match="known: a, b, c"):
        land_all(spark, registry, lake.logs, ["a", "zzz"])
    assert log.count() == 3


def test_registry():
    tables = retail_datasets("s3a://lake", "s3a://source")
    assert [t.name for t in select_datasets(tables)] == list(tables)
    assert lookup(tables, "orders").bronze_path == "s3a://lake/bronze/orders"
    assert "days_since_prior_order" not in tables["orders"].required_columns
    assert all(t.primary_key and set(t.primary_key) <= set(t.schema.names) for t in tables.values())
    for t in tables.values():
        for link in t.foreign_keys:
            assert set(link.columns) <= set(t.schema.names)
            assert set(link.parent_columns) <= set(tables[link.parent].schema.names)


def test_manifest_of_small_and_large_files(spark, root):
    root = f"{root}/with blank"
    Path(root).mkdir()
    content = {"a.csv": b"a" * 100, "b.csv": b"b" * 20_000_000, "c.txt": b"c"}
    for name, data in content.items():
        Path(f"{root}/{name}").write_bytes(data)
    found = file_manifest(spark, root, "*.csv").collect()
    assert {r.file_name: (r.file_size_bytes, r.checksum) for r in found} == {
        n: (len(content[n]), hashlib.md5(content[n]).hexdigest()) for n in ("a.csv", "b.csv")
    }
    log = spark.createDataFrame([(found[0].checksum,)] * 2, ["checksum"])
    known = already_loaded(file_manifest(spark, root), log)
    assert [r.file_name for r in known.collect()] == [found[0].file_name]


@pytest.mark.parametrize("block", [1000, 7919, 1 << 20])
def test_block_checksums_depend_on_the_block_size_alone(spark, root, block):
    data = random.Random(1).randbytes(20_000)
    Path(f"{root}/a.bin").write_bytes(data)
    parts = [hashlib.md5(data[i : i + block]).hexdigest() for i in range(0, len(data), block)]
    expected = (len(data), len(parts), hashlib.md5("".join(parts).encode()).hexdigest())
    [row] = block_manifest(spark, root, "*.bin", block).collect()
    assert (row.file_size_bytes, row.blocks, row.block_checksum) == expected


def test_content_digest_knows_no_order(spark):
    rows = [(1, "a,b"), (2, None), (2, ""), (3, 'say "x"\n'), (3, 'say "x"\n')]

    def digest(values, parts=1):
        df = spark.createDataFrame(values, "n int, s string").repartition(parts)
        return tuple(content_digest(df, "t").first())

    whole = digest(rows)
    assert whole[:2] == ("t", 5) and len(whole[2]) == 32
    assert digest(rows[::-1], 3) == whole
    assert len({digest(rows[:i])[2] for i in range(6)}) == 6 and digest([])[2] is None


def test_combined_md5_has_no_order_and_no_cancelling(spark):
    one = hashlib.md5(b"x").hexdigest()
    two = hashlib.md5(b"y").hexdigest()

    def digest(*values):
        df = spark.createDataFrame([(v,) for v in values], "m string")
        return df.agg(combined_md5(F.col("m"))).first()[0]

    assert digest(one) == one
    assert digest(one, two) == digest(two, one) != one
    assert digest(one, one) not in (digest(two, two), one)


def test_sources(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], ["name"])
    found = spark.createDataFrame([("a", 3), ("a", 0), ("b", 0)], ["name", "length"])
    got = {r.name: r.valid for r in check_sources(expected, found, "name").collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_run_columns(spark):
    start = datetime(2026, 1, 31, 23, 59, 58, 400000)
    df = spark.createDataFrame(
        [(start, start + timedelta(seconds=3.9)), (start, start - timedelta(seconds=3.9))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = df.select(duration_seconds(F.col("a"), F.col("b")), run_id(F.lit("x"), F.col("a")))
    assert [r[0] for r in got.collect()] == [3, -3]
    assert got.first()[1] == "x_20260131235958" == new_run_id("x", start.replace(tzinfo=UTC))


def test_log_rules(spark):
    now = datetime(2026, 1, 1, tzinfo=UTC)
    good = ("a", "a.csv", "/a.csv", 1, 0, 1, "x", now.date(), now, "m", "r1")
    bad = (None, None, None, 0, -1, 0, None, None, None, None, "r2")
    unknown = ("zz", *good[1:10], "r3")
    df = spark.createDataFrame([good, bad, unknown], METADATA_SCHEMA)
    broken = violations(df, metadata_rules(["a"]), ["run_id"])
    got = {}
    for r in broken.collect():
        got.setdefault(r.run_id, set()).add(r.rule)
    assert set(got) == {"r2", "r3"} and got["r3"] == {"dataset_known"}
    assert got["r2"] == {
        "dataset_name_required",
        "source_file_name_required",
        "load_date_required",
        "ingestion_timestamp_required",
        "row_count_not_negative",
        "column_count_positive",
        "file_size_positive",
        "checksum_required",
    }
    assert "Exchange" not in plan(broken)
    runs = [
        ("r1", "a", now, now, 0, "SUCCESS", 1, "f", None),
        ("r2", "a", now, now, -1, "FAILED", 0, "f", None),
        ("r3", "a", now, now, None, "RUNNING", 0, None, None),
    ]
    broken = violations(spark.createDataFrame(runs, AUDIT_SCHEMA), audit_rules(), ["run_id"])
    assert {tuple(r) for r in broken.collect()} == {
        ("r2", "duration_not_negative"),
        ("r2", "failure_explained"),
        ("r3", "status_known"),
        ("r3", "file_name_required"),
    }


def test_combined_logs(spark):
    a = spark.createDataFrame([(1, "x")], ["n", "s"])
    b = spark.createDataFrame([("y", True)], ["s", "t"])
    assert sorted(map(str, combine_logs(a, b).collect())) == sorted(
        ["Row(n=1, s='x', t=None)", "Row(n=None, s='y', t=True)"]
    )


def test_files_in_subfolders_are_landed(spark, lake):
    contract = lake("nested", None)
    Path(f"{contract.source_path}/more/deep").mkdir(parents=True)
    Path(f"{contract.source_path}/more/k=1").mkdir()
    Path(f"{contract.source_path}/_hidden").mkdir()
    for i, name in enumerate(["1.csv", "more/2.csv", "more/deep/3.csv", "more/k=1/4.csv"]):
        Path(f"{contract.source_path}/{name}").write_text(f"id,name,v\n{i},a,2\n")
    Path(f"{contract.source_path}/_hidden/5.csv").write_text("id,name,v\n9,a,2\n")
    Path(f"{contract.source_path}/none.csv").touch()
    run = land(spark, contract, lake.logs, Clock())
    assert run.row_count == 4
    bronze = read_bronze(spark, contract)
    assert sorted(r.id for r in bronze.collect()) == list("0123")
    assert bronze.columns == ["id", "name", "v", "load_date"]
    assert metadata(spark, lake)[0].file_size_bytes == 4 * len("id,name,v\n0,a,2\n")


def test_quotes_in_plain_text_are_characters(spark, lake):
    text = 'id,name,v\n1,5" pipe,2\n2,6" hose,3\n3,"say ""hi""",4\n'
    contract = lake("inches", text)
    assert land(spark, contract, lake.logs, Clock()).row_count == 3
    rows = read_bronze(spark, contract).orderBy("id").collect()
    assert [r.name for r in rows] == ['5" pipe', '6" hose', 'say "hi"']


def test_multiline_source_in_ranges(spark, lake, monkeypatch):
    """Cut in the middle of quoted text, a source lands as by one task; long rows still fail."""
    small = lambda listed, **more: csv_ranges.range_facts(listed, range_bytes=40)
    monkeypatch.setattr(landing, "range_facts", small)
    rows = [f'{i},"line one of {i}\r\nline ""two"", of {i}\n",{i}' for i in range(60)]
    contract = lake("text", "id,name,v\n" + "\n".join(rows) + '\n60,"",\n61,x\n', multiline=True)
    content = Path(contract.source_path).read_bytes()
    run = land(spark, contract, lake.logs, Clock())
    assert (run.row_count, run.checksum) == (62, hashlib.md5(content).hexdigest())
    landed = {r.id: r for r in read_bronze(spark, contract).collect()}
    assert landed["7"].name == 'line one of 7\r\nline "two", of 7\n'
    assert (landed["60"].name, landed["61"].v) == (None, None)
    Path(contract.source_path).write_text('id,name,v\n1,"a\nb",2,3\n')
    with pytest.raises(Exception, match="row has more than 3 fields"):
        land(spark, contract, lake.logs, Clock())


def test_files_are_kept_as_received(spark, lake):
    """Bytes, names, line ends, marks and quoting stay; the rows are the same."""
    texts = {
        "1.csv": b'\xef\xbb\xbfid,name,v\r\n1,"say ""hi""",2\r\n',
        "deep/1.csv": b'id,"name",v\n2,5" pipe,3',
        "deep/er/2 x.csv": b'id,name,v\n\n3,"a\r\nb",4\n',
    }
    contract = lake("kept", None, keep_files=True, multiline=True)
    for name, content in texts.items():
        path = Path(f"{contract.source_path}/{name}")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    clock = Clock()
    run = land(spark, contract, lake.logs, clock)
    assert run.row_count == 3
    [day] = Path(contract.bronze_path).iterdir()
    found = {p.name: p.read_bytes() for p in day.iterdir() if p.suffix == ".csv"}
    assert found == {n.replace("/", "__"): c for n, c in texts.items()}
    names = {r.id: r.name for r in read_bronze(spark, contract).collect()}
    assert names["1"] == 'say "hi"' and names["2"] == '5" pipe'
    [row] = metadata(spark, lake)
    assert row.file_size_bytes == sum(map(len, texts.values())) and row.column_names == "id,name,v"
    # Landed again, the day holds what the source holds then.
    Path(f"{contract.source_path}/deep/1.csv").unlink()
    clock.now -= timedelta(hours=1)
    assert land(spark, contract, lake.logs, clock).row_count == 2
    assert sorted(p.name for p in day.glob("*.csv")) == ["1.csv", "deep__er__2 x.csv"]


def test_a_kept_file_that_cannot_land_leaves_the_day_alone(spark, lake, monkeypatch):
    contract = lake("kept", GOOD, keep_files=True)
    clock = Clock()
    land(spark, contract, lake.logs, clock)
    [landed] = Path(contract.bronze_path).rglob("*.csv")
    assert (landed.name, landed.read_text()) == ("kept.csv", GOOD)
    Path(contract.source_path).write_text("id,name,v\n1,2,3,4\n")
    clock.now -= timedelta(hours=1)
    with pytest.raises(Exception, match="more than 3"):
        land(spark, contract, lake.logs, clock)
    real = landing.copy_files

    def late(listed, folder):
        Path(contract.source_path).write_text("id,name,v\n9,9,9\n")
        return real(listed, folder)

    Path(contract.source_path).write_text(GOOD)
    with monkeypatch.context() as patch:
        patch.setattr(landing, "copy_files", late)
        with pytest.raises(LandingError, match="changed while it was landed"):
            land(spark, contract, lake.logs, clock)
    assert landed.read_text() == GOOD
    assert [p.name for p in Path(contract.bronze_path).iterdir()] == [landed.parent.name]


def test_files_of_one_name_are_not_mixed_up(spark, lake):
    contract = lake("kept", None, keep_files=True)
    Path(f"{contract.source_path}/a").mkdir(parents=True)
    for name in ("a/b.csv", "a__b.csv"):
        Path(f"{contract.source_path}/{name}").write_text(GOOD)
    with pytest.raises(LandingError, match="bear one name"):
        land(spark, contract, lake.logs, Clock())


def test_packed_log_is_the_same_log(spark, root):
    path = f"{root}/audit"
    start = datetime(2026, 1, 30, 12, tzinfo=UTC)

    def record(i, day=0):
        at = start + timedelta(days=day, seconds=i)
        return {
            **{"run_id": f"t {i}/{day}", "dataset_name": "t", "start_time": at, "end_time": at},
            **{"duration_seconds": 0, "status": "SUCCESS", "records_processed": i},
            **{"file_name": "f", "error_message": None},
        }

    def log():
        return sorted(map(tuple, read_log(spark, path, AUDIT_SCHEMA).collect()), key=str)

    def files(folder):
        return len(list(Path(folder).rglob("*.parquet")))

    def pack(before):
        return pack_log(spark, path, AUDIT_SCHEMA, F.to_date("start_time"), before)

    for i, day in [(i, i % 2) for i in range(8)]:
        append_record(spark, record(i, day), path, AUDIT_SCHEMA)
    before = log()
    assert len(before) == 8
    assert pack(date(2026, 1, 31)) == 4
    # Packed runs are in both places until the next call; each counts once.
    assert (files(path), files(f"{path}_packed")) == (8, 1) and log() == before
    append_record(spark, record(9, 2), path, AUDIT_SCHEMA)
    assert pack(date(2026, 1, 31)) == 0
    assert files(path) == 5 and len(log()) == 9
    before = log()
    assert pack(date(2026, 2, 28)) == 5 and pack(date(2026, 2, 28)) == 0
    assert (files(path), files(f"{path}_packed")) == (0, 3) and log() == before
    append_record(spark, record(10, 3), path, AUDIT_SCHEMA)
    assert len(log()) == 10


POOLS = """
import sys
from pathlib import Path
from pyspark.sql import SparkSession
from millrace.contracts import Dataset, struct
from millrace.plans.landing import Logs, land_all
from millrace.session import session_settings

root, mode = sys.argv[1:]
settings = session_settings({}) | {"spark.scheduler.mode": mode}
builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", root)
builder = builder.config("spark.eventLog.compress", "false")
builder = builder.config("spark.sql.files.maxPartitionBytes", "64k")
for key, value in settings.items():
    builder = builder.config(key, value)
spark = builder.getOrCreate()
tables = {}
for name, rows in (("large", 600_000), ("small", 10)):
    Path(f"{root}/{name}.csv").write_text("id,v\\n" + "".join(f"{i},value {i}\\n" for i in range(rows)))
    tables[name] = Dataset(name, struct(), source_path=f"{root}/{name}.csv", bronze_path=f"{root}/bronze/{name}")
assert land_all(spark, tables, Logs(f"{root}/m", f"{root}/a"), parallel=2).succeeded == ["large", "small"]
spark.stop()
"""


def test_a_small_table_does_not_wait_for_a_large_one(root):
    """By the event log: the last task of the small table ends before that of the large one."""
    repository = Path(__file__).resolve().parent.parent
    command = [sys.executable, "-c", POOLS, root, "FAIR"]
    subprocess.run(command, cwd=repository, check=True, capture_output=True, timeout=300)
    pool_of, last = {}, {}
    # Rolled logs or a single one, without their checksum files.
    for log in (p for p in Path(root).rglob("*local-*") if p.is_file() and p.name[0] != "."):
        for line in log.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerStageSubmitted":
                pool = event["Properties"].get("spark.scheduler.pool")
                pool_of[event["Stage Info"]["Stage ID"]] = pool
            elif event["Event"] == "SparkListenerTaskEnd":
                pool = pool_of[event["Stage ID"]]
                last[pool] = max(last.get(pool, 0), event["Task Info"]["Finish Time"])
    assert last["landing small"] < last["landing large"]
