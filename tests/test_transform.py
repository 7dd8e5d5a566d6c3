from __future__ import annotations

from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Dataset, struct
from millrace.errors import QualityError, TransformError
from millrace.operators.cleaning import standardize_names, trim_strings
from millrace.operators.dedup import dedup_by_key
from millrace.operators.quality import QualityReport
from millrace.plans.silver import conform_and_publish
from millrace.plans.transform import HOOKS, hook, transform

CONTRACT = Dataset(
    "things",
    struct(("order_id", T.LongType(), False), ("val", T.StringType(), True)),
    primary_key=("order_id",),
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_trim_leaves_numbers_tabs_and_no_break_spaces(spark):
    df = spark.createDataFrame([(" Banana ", 10), ("\tApple  ", 20)], ["name", "price"])
    assert [tuple(r) for r in trim_strings(df).collect()] == [
        ("Banana", 10),
        ("\tApple ", 20),
    ]
    assert trim_strings(trim_strings(df)).collect() == trim_strings(df).collect()


def test_trim_handles_odd_names_and_rejects_repeated_ones(spark):
    df = spark.createDataFrame([(" a ",)], ["a.b`c"])
    assert trim_strings(df).first()[0] == "a"
    twice = spark.createDataFrame([(" x ", 1, 2)], ["name", "id", "id"])
    with pytest.raises(TransformError, match="id"):
        trim_strings(twice)


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Ship  Mode", "L_TAX", "a-b"])
    assert standardize_names(df).columns == ["ship__mode", "l_tax", "a-b"]
    with pytest.raises(TransformError, match="a_b"):
        standardize_names(spark.createDataFrame([(1, 2)], ["A b", "a B"]))


def test_dedup_on_and_off(spark):
    orders = [(32, "HIGH"), (32, "LOW"), (32, "LOW"), (1, None), (1, "URGENT")]
    df = spark.createDataFrame(orders, ["order_id", "val"])
    on = transform(df, CONTRACT, hooks={})
    assert sorted(map(tuple, on.collect()), key=str) == [(1, None), (32, "HIGH")]
    off = transform(df, replace(CONTRACT, drop_duplicates=False), hooks={})
    assert sorted(map(tuple, off.collect()), key=str) == sorted(orders, key=str)
    assert transform(df, replace(CONTRACT, primary_key=()), hooks={}).count() == 5


def test_dedup_keeps_a_column_named_like_its_rank(spark):
    df = spark.createDataFrame([(1, 9), (1, 8)], ["order_id", "_rank"])
    assert [tuple(r) for r in dedup_by_key(df, ["order_id"]).collect()] == [(1, 8)]


def test_a_contract_with_other_names_is_published_by_standard_names(spark, root):
    fields = struct(("Item Id", T.LongType(), False), ("Unit Price", T.LongType(), True))
    contract = Dataset("items", fields, primary_key=("Item Id",), silver_path=f"{root}/items")
    df = spark.createDataFrame([(1, 5), (1, 4), (2, None)], ["Item Id", "Unit Price"])
    assert conform_and_publish(df, contract, hooks={}).passed
    found = spark.read.parquet(contract.silver_path)
    assert found.columns == ["item_id", "unit_price"] and found.count() == 2


def test_dedup_needs_its_key(spark):
    with pytest.raises(TransformError, match="order_id"):
        transform(spark.createDataFrame([("a",)], ["val"]), CONTRACT, hooks={})


@settings(max_examples=8, deadline=None)
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 3)),
            st.one_of(st.none(), st.integers(0, 2)),
            st.one_of(st.none(), st.sampled_from(["", "a", "b"])),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_dedup_keeps_the_smallest_newest_row(spark, rows):
    df = spark.createDataFrame(rows, "k int, d int, v string").repartition(3)
    best = {}
    for k, d, v in rows:
        rank = (d is None, -(d or 0), v is not None, v or "")
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, d, v))
    got = dedup_by_key(df, ["k"], ["d"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(r) for _, r in best.values())
    again = dedup_by_key(got, ["k"], ["d"])
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_dedup_limits_groups_before_the_shuffle(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(0, 30000, 1, 6).select(hot.alias("k"), F.col("id").alias("v"))
    result = dedup_by_key(df, ["k"])
    text = plan(result)
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1
    before_shuffle = text.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert result.count() == 20000 + 1
    assert result.where("k = 0").first().v == 0


def test_dedup_of_maps_and_of_key_columns_only(spark):
    df = spark.createDataFrame([(1, {"b": 1}), (1, {"a": 2})], "k int, m map<string,int>")
    assert dedup_by_key(df, ["k"]).first().m == {"a": 2}
    keys = spark.createDataFrame([(1,), (1,), (2,)], ["k"])
    assert sorted(r.k for r in dedup_by_key(keys, ["k"]).collect()) == [1, 2]


def test_hook_runs_last_and_unknown_names_have_none(spark):
    df = spark.createDataFrame([(1, " A ")], ["order_id", "val"])

    @hook("things")
    def add(frame, contract):
        return frame.withColumn("seen", F.concat("val", F.lit(contract.name)))

    try:
        assert transform(df, CONTRACT).first().seen == "Athings"
    finally:
        del HOOKS["things"]
    assert transform(df, CONTRACT).columns == ["order_id", "val"]


def test_failures_are_wrapped_once(spark):
    with pytest.raises(TransformError) as wrapped:
        transform(None, CONTRACT)
    assert wrapped.value.__cause__ is not None
    own = QualityError(QualityReport("things", 0, 0, 0))

    def fail(frame, contract):
        raise own

    df = spark.createDataFrame([(1, "A")], ["order_id", "val"])
    with pytest.raises(QualityError) as raised:
        transform(df, CONTRACT, hooks={"things": fail})
    assert raised.value is own


def test_a_key_filter_reaches_the_scan(spark, root):
    spark.range(10).selectExpr("id as order_id", "'a' as val").write.parquet(f"{root}/t")
    df = transform(spark.read.parquet(f"{root}/t"), CONTRACT, hooks={}).where("order_id = 3")
    assert "EqualTo(order_id,3)" in plan(df)
