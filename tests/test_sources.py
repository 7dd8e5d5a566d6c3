from __future__ import annotations

from pathlib import Path

import pytest

from millrace.contracts import Dataset, struct
from millrace.errors import ReadError
from millrace.functions.runs import utc_now
from millrace.operators.profiles import table_profile
from millrace.session import scratch_path, session_settings
from millrace.sources.readers import peek, read_bronze, read_table


@pytest.fixture
def csv(root):
    Path(f"{root}/a.csv").write_text('id,name\n1,"a ""b"", c"\n\n2,""\n3,\n4,NA\n')
    return f"{root}/a.csv"


@pytest.mark.parametrize("token", ["csv", "CSV", "  Csv "])
def test_csv(spark, csv, token):
    df = read_table(spark, csv, token)
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert [tuple(r) for r in df.collect()] == [
        ("1", 'a "b", c'),
        ("2", None),
        ("3", None),
        ("4", "NA"),
    ]
    assert peek(df, 2).count() == 2


def test_csv_reads_only_the_columns_asked_for(spark, csv):
    plan = read_table(spark, csv, "csv").select("name")._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<name:string>" in plan.toString()


def test_parquet(spark, root):
    spark.range(3).write.parquet(f"{root}/p")
    assert read_table(spark, f"{root}/p", "parquet").count() == 3


def test_empty_folder_with_given_columns(spark, root):
    Path(f"{root}/e").mkdir()
    assert read_table(spark, f"{root}/e", "csv", columns=["a", "b"]).count() == 0


def test_unknown_format_names_the_known_ones():
    with pytest.raises(ReadError, match="'avro' is not one of: csv, parquet"):
        read_table(None, "/x", "avro")


def test_failures_carry_path_format_and_cause(spark, root):
    with pytest.raises(ReadError, match="cannot read parquet at .*/none") as raised:
        read_table(spark, f"{root}/none", "parquet")
    assert raised.value.__cause__ is not None


@pytest.mark.parametrize("gap", [{"bronze_path": ""}, {"file_format": ""}])
def test_contract_needs_path_and_format(gap):
    given = {"bronze_path": "/x", "file_format": "csv"} | gap
    with pytest.raises(ReadError, match="needs a bronze path and a file format"):
        read_bronze(None, Dataset("d", struct(), **given))


def test_load_dates_must_exist(spark, csv):
    contract = Dataset("d", struct(), bronze_path=csv)
    assert read_bronze(spark, contract).count() == 4
    with pytest.raises(ReadError, match="no load dates"):
        read_bronze(spark, contract, "latest")


def test_profile(spark, csv):
    row = table_profile(read_table(spark, csv, "csv"), "a").first()
    assert tuple(row) == ("a", 4, 2, "id,name")


def test_session_settings():
    plain = session_settings({})
    assert plain["spark.sql.sources.partitionOverwriteMode"] == "dynamic"
    assert "spark.sql.shuffle.partitions" not in plain
    given = session_settings(
        {"LAKE_S3_ENDPOINT": "http://store:9000", "SPARK_SHUFFLE_PARTITIONS": "2000"}
    )
    assert given["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert given["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert given["spark.sql.shuffle.partitions"] == "2000"


def test_scratch_paths_are_fresh_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)


def test_clock_is_utc():
    assert utc_now().utcoffset().total_seconds() == 0
