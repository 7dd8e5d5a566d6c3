from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import struct
from millrace.errors import SchemaError
from millrace.functions.casts import lenient_cast
from millrace.operators.schema import cast_failures, enforce_schema

INTEGERS = [
    ("12", 12),
    ("-12", -12),
    ("+12", 12),
    (" 12 ", 12),
    ("\t12\n", 12),
    ("\x7f12", 12),
    ("0012", 12),
    ("00000000000000000000000012", 12),
    ("-0", 0),
    ("12.7", 12),
    ("-12.7", -12),
    ("12.", 12),
    (".5", 0),
    ("-.5", 0),
    (".", 0),
    ("2147483647", 2147483647),
    ("-2147483648", -2147483648),
    ("2147483648", None),
    ("-2147483649", None),
    ("99999999999", None),
    ("9" * 40, None),
    ("", None),
    (" ", None),
    ("+", None),
    ("1e3", None),
    ("1,000", None),
    ("12a", None),
    ("5 ", 5),
    ("2024-01-02", None),
    ("10:30", None),
    ("1 2", None),
    ("--1", None),
    ("1.2.3", None),
    (" 12", None),
    ("NULL", None),
    (None, None),
]


def cast_all(spark, values, target):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    cast = lenient_cast(F.col("v"), T.StringType(), target)
    return [r[0] for r in df.orderBy("i").select(cast).collect()]


def test_text_to_int(spark):
    got = cast_all(spark, [v for v, _ in INTEGERS], T.IntegerType())
    assert list(zip([v for v, _ in INTEGERS], got)) == INTEGERS


def test_text_to_int_equals_the_non_ansi_cast(spark):
    df = spark.createDataFrame([(v,) for v, _ in INTEGERS], "v string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("v").cast("int")).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert cast_all(spark, [v for v, _ in INTEGERS], T.IntegerType()) == legacy


@pytest.mark.parametrize(
    "target", [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]
)
@settings(max_examples=5, deadline=None)
@given(
    values=st.lists(
        st.one_of(
            st.text(alphabet="0123456789+-. eEfdNnaix\t", max_size=12),
            st.integers(-(1 << 65), 1 << 65).map(str),
            st.floats().map(str),
        ),
        min_size=100,
        max_size=300,
    )
)
def test_any_text_casts_as_without_ansi(spark, values, target):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = cast_all(spark, values, target)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        ordered = df.orderBy("i").select(F.col("v").cast(target))
        legacy = [r[0] for r in ordered.collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [str(v) for v in got] == [str(v) for v in legacy]


def test_other_targets(spark):
    assert cast_all(spark, ["9223372036854775807", "9223372036854775808"], T.LongType()) == [
        9223372036854775807,
        None,
    ]
    doubles = cast_all(spark, ["1e3", " -.5 ", "x1", "Infinity", "0x1p3", ""], T.DoubleType())
    assert doubles == [1000.0, -0.5, None, float("inf"), 8.0, None]
    assert cast_all(spark, ["1.239", "1e2", "abc", "123456"], T.DecimalType(5, 2)) == [
        Decimal("1.24"),
        Decimal("100.00"),
        None,
        None,
    ]
    assert cast_all(spark, ["yes", " F ", "2"], T.BooleanType()) == [True, False, None]
    dates = cast_all(spark, ["2024-02-29", "2023-02-29", "x"], T.DateType())
    assert [d and d.isoformat() for d in dates] == ["2024-02-29", None, None]


TARGET = struct(("id", T.IntegerType(), False), ("name", T.StringType(), True))


def test_enforce_schema_orders_drops_and_casts(spark):
    df = spark.createDataFrame([("x", "a", "1.0"), ("y", "b", "bad")], ["more", "name", "id"])
    typed = enforce_schema(df, TARGET, "t")
    assert typed.dtypes == [("id", "int"), ("name", "string")]
    assert [tuple(r) for r in typed.collect()] == [(1, "a"), (None, "b")]
    assert df.columns == ["more", "name", "id"]
    assert enforce_schema(df, TARGET, "t", keep=["more"]).columns == ["id", "name", "more"]


@pytest.mark.parametrize("columns, absent", [(["id"], "name"), (["ID", "NAME"], "id, name")])
def test_all_missing_columns_are_named(spark, columns, absent):
    df = spark.createDataFrame([tuple("1" for _ in columns)], columns)
    with pytest.raises(SchemaError, match=f"t: columns {absent} are missing"):
        enforce_schema(df, TARGET, "t")


def test_double_to_int_cuts_and_does_not_overflow(spark):
    df = spark.createDataFrame([(1.9, "a"), (-1.9, "b"), (1e12, "c")], ["id", "name"])
    assert [r.id for r in enforce_schema(df, TARGET, "t").collect()] == [1, -1, None]


def test_cast_failures_counts_lost_values_only(spark):
    df = spark.createDataFrame([("1", "a"), ("x", None), (None, "b")], ["id", "name"])
    lost = {r["column"]: r.lost_values for r in cast_failures(df, TARGET, "t").collect()}
    assert lost == {"id": 1, "name": 0}
    empty = cast_failures(df.limit(0), TARGET, "t").collect()
    assert [r.lost_values for r in empty] == [0, 0]
