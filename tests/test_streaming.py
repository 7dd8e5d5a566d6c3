from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Dataset, ForeignKey, struct
from millrace.errors import ContractError
from millrace.streaming import incremental
from millrace.streaming.incremental import (
    land_new_files,
    land_unique_new_files,
    landed,
    merge_new_files,
    read_new_files,
    release_orphans,
)

EVENTS = Dataset(
    "events",
    struct(
        ("id", T.IntegerType(), False),
        ("ts", T.TimestampType(), False),
        ("v", T.StringType(), True),
    ),
    primary_key=("id",),
    write_mode="merge",
)


def arrive(spark, root, values):
    df = spark.createDataFrame(values, "id int, ts string, v string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(f"{root}/source")


def stream(spark, root):
    return read_new_files(spark, f"{root}/source", EVENTS.schema, files_per_batch=1)


def test_each_file_lands_once_and_late_rows_stay(spark, root):
    def run():
        day = F.to_date("ts")
        land_new_files(stream(spark, root), f"{root}/bronze", f"{root}/checkpoint", day)
        return spark.read.parquet(f"{root}/bronze")

    arrive(spark, root, [(1, "2026-03-01 10:00:00", "a"), (2, "2026-03-02 10:00:00", "b")])
    assert run().count() == 2
    assert run().count() == 2
    arrive(spark, root, [(3, "2020-01-01 00:00:00", "late"), (1, "2026-03-01 10:00:00", "a")])
    landed = run()
    assert landed.count() == 4
    assert landed.where("load_date = '2020-01-01'").first().v == "late"


def test_load_date_defaults_to_today(spark, root):
    arrive(spark, root, [(1, "2026-03-01 10:00:00", "a")])
    land_new_files(stream(spark, root), f"{root}/bronze", f"{root}/checkpoint")
    landed = spark.read.parquet(f"{root}/bronze")
    assert landed.where(F.col("load_date") >= F.date_sub(F.current_date(), 1)).count() == 1


@pytest.mark.parametrize("parts", [(), ("v",)])
def test_batches_are_merged_by_key(spark, root, parts):
    contract = replace(EVENTS, silver_path=f"{root}/silver", partition_columns=parts)

    def run():
        merge_new_files(stream(spark, root), contract, f"{root}/checkpoint")
        df = spark.read.parquet(contract.silver_path)
        return {r.id: r.v for r in df.collect()}

    arrive(spark, root, [(1, "2026-03-01 10:00:00", "a"), (2, "2026-03-02 10:00:00", " b ")])
    assert run() == {1: "a", 2: "b"}
    arrive(spark, root, [(2, "2026-03-03 10:00:00", "c"), (3, "2026-03-03 10:00:00", "a")])
    arrive(spark, root, [(3, "2026-03-04 10:00:00", "d")])
    assert run() == {1: "a", 2: "c", 3: "d"}
    assert run() == {1: "a", 2: "c", 3: "d"}


def land_unique(spark, root, spread=1):
    land_unique_new_files(
        *[stream(spark, root), f"{root}/unique", f"{root}/unique-checkpoint", ["id"], "ts"],
        **{"remember": "30 days", "late_after": "1 day", "spread": spread},
    )
    both = landed(spark, f"{root}/unique", None).collect()
    return sorted(((r.id, r.v, r.late) for r in both), key=str)


@pytest.mark.parametrize("spread", [1, 3])
def test_a_key_lands_once_whichever_batch_repeats_it(spark, root, spread):
    arrive(spark, root, [(1, "2026-03-05 10:00:00", "a"), (1, "2026-03-05 10:00:00", "a")])
    arrive(spark, root, [(1, "2026-03-05 10:00:00", "a"), (2, "2026-03-05 11:00:00", "b")])
    first = [(1, "a", False), (2, "b", False)]
    assert land_unique(spark, root, spread=spread) == first
    assert land_unique(spark, root, spread=spread) == first
    # Known keys are dropped, late or not; new keys that are late go to the side.
    arrive(spark, root, [(2, "2026-03-05 11:00:00", "b"), (3, "2026-03-01 00:00:00", "late")])
    arrive(spark, root, [(3, "2026-03-01 00:00:00", "late"), (4, "2026-03-04 12:00:00", "in time")])
    arrive(spark, root, [(5, None, "no time"), (None, "2026-03-06 00:00:00", "no key")])
    arrive(spark, root, [(None, "2026-03-06 00:00:00", "no key")])
    second = [*first, (3, "late", True), (4, "in time", False), (5, "no time", False)]
    both = land_unique(spark, root, spread=spread)
    assert both == sorted([*second, (None, "no key", False)], key=str)
    assert [r.id for r in landed(spark, f"{root}/unique", True).collect()] == [3]
    assert landed(spark, f"{root}/unique").count() == 5


def test_the_newest_date_alone_tells_the_mark(spark, root):
    arrive(spark, root, [(1, "2026-03-05 10:00:00", "a"), (2, "2026-03-01 10:00:00", "b")])
    land_unique(spark, root)
    path = f"{root}/unique"
    assert incremental._greatest_event_time(spark, path, "ts") == datetime(2026, 3, 5, 10)
    assert incremental._greatest_event_time(spark, f"{root}/none", "ts") is None


CHILD = replace(
    EVENTS,
    foreign_keys=(ForeignKey(("v",), "kinds", ("kind",)), ForeignKey(("id",), "ids", ("id",))),
    version=("ts",),
)


def published(spark, contract):
    return sorted((r.id, r.v) for r in spark.read.parquet(contract.silver_path).collect())


def known(spark, kinds, ids):
    return {
        "kinds": spark.createDataFrame([(k,) for k in kinds], "kind string"),
        "ids": spark.createDataFrame([(i,) for i in ids], "id int"),
    }


def test_an_orphan_stops_the_stream_before_its_batch(spark, root):
    contract = replace(CHILD, silver_path=f"{root}/silver")

    def run(parents):
        merge_new_files(stream(spark, root), contract, f"{root}/checkpoint", parents=parents)

    arrive(spark, root, [(1, "2026-03-01 10:00:00", "a"), (2, "2026-03-01 10:00:00", None)])
    run(known(spark, "ab", [1, 2, 3]))
    arrive(spark, root, [(3, "2026-03-01 10:00:00", "c"), (1, "2026-03-02 10:00:00", "b")])
    with pytest.raises(StreamingQueryException, match="Reference 'v' has 1 key"):
        run(known(spark, "ab", [1, 2, 3]))
    assert published(spark, contract) == [(1, "a"), (2, None)]
    # The batch is taken up again once the parent is there; parents are read per batch.
    run(lambda: known(spark, "abc", [1, 2, 3]))
    assert published(spark, contract) == [(1, "b"), (2, None), (3, "c")]


def test_orphans_wait_at_the_side(spark, root):
    contract = replace(CHILD, silver_path=f"{root}/silver")
    aside = f"{root}/orphans"

    def run(parents):
        options = {"parents": parents, "orphans_path": aside}
        merge_new_files(stream(spark, root), contract, f"{root}/checkpoint", **options)

    arrive(spark, root, [(1, "2026-03-01 10:00:00", "a"), (9, "2026-03-01 10:00:00", "x")])
    arrive(spark, root, [(2, "2026-03-01 10:00:00", "x"), (3, "2026-03-01 10:00:00", "a")])
    run(known(spark, "ab", [1, 2, 3]))
    assert published(spark, contract) == [(1, "a"), (3, "a")]
    waiting = {r.id: r.missing_parents for r in spark.read.parquet(aside).collect()}
    assert waiting == {9: ["v", "id"], 2: ["v"]}
    # A newer row of a waiting key is published meanwhile: the older one does not undo it.
    arrive(spark, root, [(2, "2026-03-05 10:00:00", "b")])
    run(known(spark, "ab", [1, 2, 3]))
    assert release_orphans(spark, contract, aside, known(spark, "abx", [1, 2, 3])) == 1
    assert published(spark, contract) == [(1, "a"), (2, "b"), (3, "a")]
    assert release_orphans(spark, contract, aside, known(spark, "abx", [1, 2, 3, 9])) == 0
    assert published(spark, contract) == [(1, "a"), (2, "b"), (3, "a"), (9, "x")]
    assert release_orphans(spark, contract, aside, {}) == 0
    assert release_orphans(spark, contract, f"{root}/nothing", {}) == 0
    with pytest.raises(ContractError, match="by version only"):
        release_orphans(spark, replace(contract, version=()), aside, {})
    with pytest.raises(ContractError, match="by their parents only"):
        merge_new_files(stream(spark, root), contract, f"{root}/c", orphans_path=aside)
