from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Dataset, ForeignKey, struct
from millrace.errors import ContractError, QualityError
from millrace.operators.lookups import rows_with_keys
from millrace.operators.quality import duplicate_keys, evaluate, gate, null_counts, quality_checks, table_facts
from millrace.operators.references import orphan_keys, orphan_rows, reference_report

EMPTY = struct()


def contract(required=(), key=(), **more) -> Dataset:
    return Dataset("data", EMPTY, primary_key=tuple(key), required=tuple(required), **more)


def test_good_table_passes(spark):
    nations = [(0, "ALGERIA", 0), (5, "ETHIOPIA", 0), (8, "INDIA", 2)]
    df = spark.createDataFrame(nations, ["n_nationkey", "n_name", "n_regionkey"])
    report = gate(df, contract(["n_name", "n_regionkey"], ["n_nationkey"]))
    assert report.passed and report.errors == []
    assert (report.total_records, report.duplicate_records) == (3, 0)
    assert report.null_counts == {"n_nationkey": 0, "n_name": 0, "n_regionkey": 0}


def test_missing_columns(spark):
    df = spark.createDataFrame([(7.5,)], ["s_acctbal"])
    with pytest.raises(QualityError) as raised:
        gate(df, contract(["s_name", "s_acctbal", "s_phone"], ["s_suppkey"]))
    assert raised.value.report.errors == [
        "required, but not in the table: s_name, s_phone",
        "part of the key, but not in the table: s_suppkey",
    ]


def test_nulls_in_required_and_key_columns(spark):
    parts = [(None, "LARGE BRASS"), (None, "SMALL TIN"), (12, None)]
    df = spark.createDataFrame(parts, "p_partkey int, p_type string")
    report = evaluate(df, contract(["p_type"], ["p_partkey"]))
    assert report.null_counts == {"p_type": 1, "p_partkey": 2}
    # NULL is one key, and two rows have it.
    assert report.errors == [
        "Required column 'p_type' has 1 NULL(s)",
        "Key column 'p_partkey' has 2 NULL(s)",
        "1 key(s) occur more than once",
    ]
    # A key column that is required too is reported once.
    both = evaluate(df, contract(["p_partkey"], ["p_partkey"])).errors
    assert both[0] == "Required column 'p_partkey' has 2 NULL(s)" and len(both) == 2


def test_counters_do_not_clash_with_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], ["copies", "rows"])
    assert [tuple(r) for r in duplicate_keys(df, ["copies"]).collect()] == [(1, 2)]
    link = ForeignKey(("rows",), "parent", ("copies",))
    assert sorted(tuple(r) for r in orphan_keys(df, df, link).collect()) == [(2, 2), (4, 1)]


def test_duplicates_count_keys_not_rows(spark):
    lines = [(7, 1), (7, 1), (7, 1), (7, 2), (8, 1), (8, 1)]
    df = spark.createDataFrame(lines, ["l_orderkey", "l_linenumber"])
    report = evaluate(df, contract(key=["l_orderkey", "l_linenumber"]))
    assert (report.duplicate_records, report.removable_records) == (2, 3)
    assert report.errors == ["2 key(s) occur more than once"]


def test_problems_come_together_in_order(spark):
    df = spark.createDataFrame([(4,), (None,), (4,), (6,), (6,)], "c_custkey int")
    report = evaluate(df, contract(["c_custkey", "c_phone"], ["c_custkey"]))
    assert report.errors == [
        "required, but not in the table: c_phone",
        "Required column 'c_custkey' has 1 NULL(s)",
        "2 key(s) occur more than once",
    ]


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None,), (None,), (3,)], "id int")
    assert evaluate(df, contract(key=["id"])).duplicate_records == 1


def test_present_part_of_a_key_is_checked(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], ["a", "b"])
    assert evaluate(df, contract(key=["a", "c"])).duplicate_records == 1


def test_empty_table_and_no_checks(spark):
    df = spark.createDataFrame([], "id int, val string")
    report = gate(df, contract(["val"], ["id"]))
    assert (report.total_records, report.null_counts) == (0, {"val": 0, "id": 0})
    assert gate(df, contract()).passed
    assert quality_checks(df, contract()).count() == 0
    assert null_counts(df, ["id"]).first()["id"] == 0


def test_columns_with_the_names_of_counters(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, None)], "count int, n int, o0 string")
    report = evaluate(df, contract(["o0", "n"], ["count", "n"]))
    assert report.duplicate_records == 1
    assert report.null_counts == {"o0": 2, "n": 0, "count": 0}


def test_unique_keys_need_no_grouping(spark):
    df = spark.range(100).select("id", F.lit(None).cast("int").alias("v"))
    report = evaluate(df, contract(["v"], ["id"]), keys_are_unique=True)
    assert (report.total_records, report.null_counts) == (100, {"v": 100, "id": 0})
    plan = table_facts(df, ["v"], [])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_default_required_columns_follow_the_schema():
    schema = struct(("a", T.IntegerType(), False), ("b", T.IntegerType(), True))
    assert Dataset("d", schema).required_columns == ("a",)


@settings(max_examples=8, deadline=None)
@given(
    rows=st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 1))),
        max_size=30,
    )
)
def test_facts_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    facts = table_facts(df, ["k", "v"], ["k"]).first()
    keys = Counter(k for k, _ in rows)
    assert facts.total == len(rows) == len(keys) + facts.surplus
    assert facts.duplicates == sum(n > 1 for n in keys.values())
    assert facts.n0 == keys[None]
    assert facts.n1 == sum(v is None for _, v in rows)


LINK = ForeignKey(("fk",), "parent", ("id",))


def test_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id int, fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], ["id"])
    assert [tuple(r) for r in orphan_keys(child, parent, LINK).collect()] == [(9, 2)]
    assert sorted(r.id for r in orphan_rows(child, parent, LINK).collect()) == [2, 3]
    report = reference_report(child, contract(foreign_keys=(LINK,)), {"parent": parent})
    assert tuple(report.first()) == ("data", "fk", "parent", 1, 2)
    clean = reference_report(
        child.where("fk = 1"), contract(foreign_keys=(LINK,)), {"parent": parent}
    )
    assert tuple(clean.first())[3:] == (0, 0)
    with pytest.raises(ContractError):
        reference_report(child, contract(), {})


def test_the_gate_checks_references_against_given_parents(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id int, fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], ["id"])
    linked = contract(foreign_keys=(LINK,))
    assert gate(child, linked).passed and gate(child, linked).orphan_rows == {}
    with pytest.raises(QualityError, match="'fk' has 1 key.s. that are not in parent, in 2 row"):
        gate(child, linked, parents={"parent": parent})
    assert gate(child.where("fk = 1"), linked, parents={"parent": parent}).orphan_rows == {"fk": 0}


def test_orphan_keys_are_counted_before_the_join(spark):
    child = spark.range(10000).select((F.col("id") % 2).alias("fk"))
    # A parent small enough for a broadcast filters the rows before the count.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = orphan_keys(child, spark.range(1), LINK)
        plan = keys._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan[plan.index("SortMergeJoin") :]
        assert [tuple(r) for r in keys.collect()] == [(1, 5000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [0, 100])
def test_rows_with_keys_small_and_large(spark, monkeypatch, limit):
    monkeypatch.setattr("millrace.operators.lookups.BROADCAST_KEYS", limit)
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    keys = spark.createDataFrame([(1, 0), (1, 0), (None, 0)], "k int, other int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        picked = rows_with_keys(df, keys, ["k"])
        text = picked._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in text) == (limit > 0)
        assert sorted(r.v for r in picked.collect()) == ["a", "b"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
