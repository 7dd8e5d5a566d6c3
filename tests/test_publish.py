from __future__ import annotations

import random
from datetime import date
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Dataset, struct
from millrace.errors import ContractError, QualityError
from millrace.operators import quality
from millrace.plans.silver import conform, run_silver
from millrace.session import drop_path, path_exists
from millrace.sinks import tables
from millrace.sinks.tables import replace_table, upsert, write_table
from millrace.sources.readers import read_bronze

COLUMNS = "k int, p string, v int"


def rows(spark, path):
    df = spark.read.schema(COLUMNS).parquet(path)
    return sorted((tuple(r) for r in df.select("k", "p", "v").collect()), key=str)


def frame(spark, values):
    return spark.createDataFrame(values, COLUMNS)


def test_modes(spark, root):
    path = f"{root}/t"
    write_table(frame(spark, [(1, "a", 1)]), path)
    write_table(frame(spark, [(2, "a", 2)]), path, mode="append")
    assert rows(spark, path) == [(1, "a", 1), (2, "a", 2)]
    write_table(frame(spark, [(3, "b", 3)]), path, compression="zstd")
    assert rows(spark, path) == [(3, "b", 3)]
    assert list(Path(path).glob("*.zstd.parquet"))
    with pytest.raises(Exception):
        write_table(frame(spark, [(3, "b", 3)]), path, mode="errorifexists")


def test_overwrite_replaces_touched_partitions_only(spark, root):
    path = f"{root}/t"
    write_table(frame(spark, [(1, "a", 1), (2, "b", 2)]), path, partition_columns=["p"])
    write_table(frame(spark, [(9, "b", 9)]), path, partition_columns=["p"])
    assert rows(spark, path) == [(1, "a", 1), (9, "b", 9)]


def test_one_file_per_partition_of_modest_size(spark, root):
    path = f"{root}/t"
    many = spark.range(0, 4000, 1, 8).selectExpr("cast(id as int) k", "cast(id % 5 as string) p")
    write_table(many, path, partition_columns=["p"])
    assert len(list(Path(path).rglob("*.parquet"))) == 5


BASE = [(1, "a", 1), (2, "a", 2), (3, "b", 3), (None, "b", 0)]


def check_upsert(spark, root, changes, parts, base=BASE):
    path = f"{root}/t{random.random()}"
    options = {"partition_columns": parts, "key": ["k"]}
    write_table(frame(spark, base), path, **options)
    write_table(frame(spark, changes), path, mode="merge", **options)
    new = {k for k, _, _ in changes}
    expected = [r for r in base if r[0] not in new] + changes
    assert rows(spark, path) == sorted(expected, key=str)
    return path


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_upsert_replaces_and_inserts(spark, root, parts):
    check_upsert(spark, root, [(2, "a", 20), (4, "b", 40), (None, "b", 7)], parts)


def test_upsert_moves_rows_between_partitions(spark, root):
    path = check_upsert(spark, root, [(3, "a", 30), (None, "c", 1)], ["p"])
    assert not Path(f"{path}/p=b").exists()


def test_upsert_with_null_partition(spark, root):
    check_upsert(spark, root, [(5, None, 5)], ["p"], [*BASE, (6, None, 6)])


def test_upsert_with_other_columns_is_refused(spark, root):
    path = f"{root}/t"
    write_table(frame(spark, BASE), path)
    for changes in (frame(spark, BASE).drop("v"), frame(spark, BASE).withColumn("w", F.lit(1))):
        with pytest.raises(ContractError, match="columns differ"):
            upsert(changes, path, ["k"])
    assert spark.read.parquet(path).columns == ["k", "p", "v"]


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_the_greater_version_stays(spark, root, parts):
    path = f"{root}/t"
    options = {"partition_columns": parts, "key": ["k"], "version": ["v"]}
    write_table(frame(spark, [(1, "a", 5), (2, "b", 5)]), path, **options)
    write_table(frame(spark, [(1, "c", 4), (2, "a", 6)]), path, mode="merge", **options)
    assert rows(spark, path) == [(1, "a", 5), (2, "a", 6)]


def test_a_moved_row_leaves_other_partitions_alone(spark, root):
    path = f"{root}/t"
    options = {"partition_columns": ["p"], "key": ["k"]}
    write_table(frame(spark, [*BASE, (9, "x/y", 9)]), path, **options)
    before = {f.name for f in Path(f"{path}/p=b").glob("*.parquet")}
    write_table(frame(spark, [(9, "a", 90)]), path, mode="merge", **options)
    assert {f.name for f in Path(f"{path}/p=b").glob("*.parquet")} == before
    assert sorted(f.name for f in Path(path).glob("p=*")) == ["p=a", "p=b"]


def test_a_dropped_table_stays_dropped(spark, root):
    path = f"{root}/t"
    frame(spark, BASE).write.parquet(tables._staging(spark, path))
    upsert(frame(spark, [(7, "c", 7)]), path, ["k"])
    assert rows(spark, path) == [(7, "c", 7)]


def test_upsert_leaves_untouched_partitions_alone(spark, root):
    path = f"{root}/t"
    options = {"partition_columns": ["p"], "key": ["k"]}
    write_table(frame(spark, BASE), path, **options)
    before = {f.name for f in Path(f"{path}/p=b").glob("*.parquet")}
    write_table(frame(spark, [(1, "a", 10)]), path, mode="merge", **options)
    assert {f.name for f in Path(f"{path}/p=b").glob("*.parquet")} == before


def test_upsert_of_nothing_and_into_nothing(spark, root):
    check_upsert(spark, root, [], [])
    check_upsert(spark, root, [], ["p"])
    upsert(frame(spark, BASE), f"{root}/new", ["k"], partition_columns=["p"])
    assert len(rows(spark, f"{root}/new")) == 4


@settings(max_examples=5, deadline=None)
@given(
    base=st.dictionaries(st.integers(0, 9), st.sampled_from("ab"), min_size=1),
    changes=st.dictionaries(st.integers(0, 12), st.sampled_from("abc"), min_size=1),
)
def test_upsert_equals_brute_force(spark, tmp_path_factory, base, changes):
    root = str(tmp_path_factory.mktemp("upsert"))
    check_upsert(
        spark,
        root,
        [(k, p, 2) for k, p in changes.items()],
        ["p"],
        [(k, p, 1) for k, p in base.items()],
    )


def test_a_table_can_replace_itself(spark, root):
    path = f"{root}/t"
    write_table(frame(spark, BASE), path)
    replace_table(spark.read.parquet(path).where("v > 1"), path)
    assert rows(spark, path) == [(2, "a", 2), (3, "b", 3)]
    assert not path_exists(spark, tables._staging(spark, path))


def test_an_interrupted_replacement_is_finished(spark, root, monkeypatch):
    path = f"{root}/t"
    write_table(frame(spark, BASE), path)

    def die(spark, path, *_):
        # As if the driver died after the old files were deleted.
        drop_path(spark, path)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_publish_staged", die)
        with pytest.raises(KeyboardInterrupt):
            upsert(frame(spark, [(2, "a", 20)]), path, ["k"])
    assert not Path(path).exists()
    upsert(frame(spark, [(7, "c", 7)]), path, ["k"])
    assert rows(spark, path) == sorted(
        [(1, "a", 1), (2, "a", 20), (3, "b", 3), (7, "c", 7), (None, "b", 0)], key=str
    )


class Killed(Exception):
    """As if the driver died."""


@pytest.mark.parametrize("stop", range(5))
def test_no_row_is_lost_wherever_an_upsert_breaks_off(spark, root, monkeypatch, stop):
    """Key 1 moves from one partition to another, which leaves its old one empty."""
    path = f"{root}/t"
    options = {"partition_columns": ["p"], "key": ["k"]}
    write_table(frame(spark, [(1, "a", 1), (2, "b", 2)]), path, **options)
    changes = frame(spark, [(1, "b", 10)])
    step = iter(range(100))

    def stopping(function, after):
        """`function` that dies at a step, before or after its work."""

        def run(*args, **kwargs):
            if not after and next(step) == stop:
                raise Killed
            function(*args, **kwargs)
            if after and next(step) == stop:
                raise Killed

        return run

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_stage", stopping(tables._stage, False))
        patch.setattr(tables, "_write", stopping(stopping(tables._write, False), True))
        patch.setattr(tables, "drop_path", stopping(tables.drop_path, False))
        with pytest.raises(Killed):
            upsert(changes, path, ["k"], partition_columns=["p"])
    staged = path_exists(spark, f"{tables._staging(spark, path)}/intent/_SUCCESS")
    assert staged == (stop > 0) and tables.recover(spark, path) == staged
    # Before the record is complete the table is as it was; after that the change is made.
    expected = [(1, "b", 10), (2, "b", 2)] if staged else [(1, "a", 1), (2, "b", 2)]
    assert rows(spark, path) == expected
    assert not tables.recover(spark, path)
    upsert(frame(spark, [(3, "a", 3)]), path, ["k"], partition_columns=["p"])
    assert rows(spark, path) == sorted([*expected, (3, "a", 3)], key=str)


def test_a_broken_off_write_is_completed_by_the_next_one(spark, root, monkeypatch):
    path = f"{root}/t"
    options = {"partition_columns": ["p"], "key": ["k"]}

    def broken_upsert():
        def die(*_):
            raise Killed

        with monkeypatch.context() as patch:
            patch.setattr(tables, "_write", die)
            with pytest.raises(Killed):
                upsert(frame(spark, [(1, "a", 10)]), path, ["k"], partition_columns=["p"])

    # The very first write may break off too.
    broken_upsert()
    write_table(frame(spark, [(5, "c", 5)]), path, mode="append", **options)
    assert rows(spark, path) == [(1, "a", 10), (5, "c", 5)]
    broken_upsert()
    write_table(frame(spark, [(6, "c", 6)]), path, **options)
    assert rows(spark, path) == [(1, "a", 10), (6, "c", 6)]
    broken_upsert()
    write_table(frame(spark, [(7, "d", 7)]), path, whole=True, **options)
    assert rows(spark, path) == [(7, "d", 7)]
    assert not tables.recover(spark, path)


# The whole silver job

ITEMS = Dataset(
    "items",
    struct(
        ("id", T.IntegerType(), False),
        ("name", T.StringType(), False),
        ("price", T.DoubleType(), True),
        ("kind", T.StringType(), True),
    ),
    primary_key=("id",),
)


def bronze(root, load_date, text):
    folder = Path(f"{root}/bronze/load_date={load_date}")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "items.csv").write_text("id,name,price,kind,more\n" + text)


def items(root, **more) -> Dataset:
    from dataclasses import replace

    return replace(ITEMS, bronze_path=f"{root}/bronze", silver_path=f"{root}/silver", **more)


def silver(spark, root):
    columns = ["id", "name", "price", "kind"]
    df = spark.read.parquet(f"{root}/silver")
    assert sorted(df.columns) == sorted(columns)
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_silver_job_keeps_the_newest_load(spark, root):
    bronze(root, "2026-01-01", '1, apple ,1.5,a,x\n2,"pear, ripe",bad,b,x\n')
    bronze(root, "2026-01-02", "1,Apple,2.5,a,y\n3,fig,,b,y\n3,fig,9,b,y\n")
    contract = items(root, partition_columns=("kind",))
    report = run_silver(spark, contract)
    assert (report.total_records, report.null_counts) == (3, {"id": 0, "name": 0})
    assert silver(spark, root) == [
        (1, "Apple", 2.5, "a"),
        (2, "pear, ripe", None, "b"),
        (3, "fig", None, "b"),
    ]
    run_silver(spark, contract)
    assert len(silver(spark, root)) == 3
    run_silver(spark, contract, load_dates=[date(2026, 1, 1)])
    assert silver(spark, root)[0] == (1, "apple", 1.5, "a")


def test_the_writing_job_counts_for_the_gate(spark, root, monkeypatch):
    """With unique keys nothing is read again, and the report is the same as by reading."""
    bronze(root, "2026-01-30", "1,a,1,x,\n2,,2,,\n2,b,2,,\n,c,3,,\n,d,3,,\n")
    contract = items(root, required=("name", "price"))
    rows = conform(read_bronze(spark, contract), contract)
    by_reading = quality.evaluate(rows, contract)
    with monkeypatch.context() as patch:
        patch.setattr(quality, "table_facts", None)
        with pytest.raises(QualityError) as raised:
            run_silver(spark, contract)
        assert raised.value.report == by_reading
        assert by_reading.null_counts == {"name": 1, "price": 0, "id": 1}
        # A table without rows has counts too.
        empty = items(f"{root}/empty", partition_columns=("kind",))
        bronze(f"{root}/empty", "2026-01-30", "")
        assert run_silver(spark, empty).total_records == 0


def test_silver_job_publishes_nothing_that_fails(spark, root):
    bronze(root, "2026-01-01", "1,apple,1,a,x\n")
    contract = items(root)
    run_silver(spark, contract)
    bronze(root, "2026-01-02", "x,bad key,1,a,x\n4,,1,a,x\n")
    with pytest.raises(QualityError) as raised:
        run_silver(spark, contract)
    assert raised.value.report.errors == [
        "Required column 'id' has 1 NULL(s)",
        "Required column 'name' has 1 NULL(s)",
    ]
    assert silver(spark, root) == [(1, "apple", 1.0, "a")]


def test_silver_job_merges(spark, root):
    contract = items(root, write_mode="merge")
    bronze(root, "2026-01-01", "1,apple,1,a,x\n2,pear,2,a,x\n")
    run_silver(spark, contract, "latest")
    bronze(root, "2026-01-02", "2,PEAR,3,a,x\n5,kiwi,5,c,x\n")
    run_silver(spark, contract, "latest")
    assert silver(spark, root) == [
        (1, "apple", 1.0, "a"),
        (2, "PEAR", 3.0, "a"),
        (5, "kiwi", 5.0, "c"),
    ]


def test_duplicates_made_by_a_hook_are_caught(spark, root):
    bronze(root, "2026-01-01", "1,apple,1,a,x\n2,pear,2,a,x\n")
    hooks = {"items": lambda df, contract: df.withColumn("id", F.lit(1))}
    with pytest.raises(QualityError, match="1 key"):
        run_silver(spark, items(root), hooks=hooks)


def test_conforming_is_lazy(spark, root):
    bronze(root, "2026-01-01", "1,apple,1,a,x\n")
    df = spark.read.option("header", True).csv(f"{root}/bronze")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    conform(df, items(root))
    assert not tracker.getJobIdsForGroup("lazy")
