"""Contracts of the test tables, in the roles the retail tables have."""

from __future__ import annotations

from pyspark.sql import types as T

from millrace.contracts import Dataset, ForeignKey, struct

_INT, _LONG, _DOUBLE, _STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_TIME = T.TimestampNTZType()

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

REGION = Dataset(
    "region",
    struct(("r_regionkey", _INT, False), ("r_name", _STRING, False)),
    primary_key=("r_regionkey",),
)
NATION = Dataset(
    "nation",
    struct(
        ("n_nationkey", _INT, False),
        ("n_name", _STRING, False),
        ("n_regionkey", _INT, False),
    ),
    primary_key=("n_nationkey",),
    foreign_keys=(ForeignKey(("n_regionkey",), "region", ("r_regionkey",)),),
)
CUSTOMER = Dataset(
    "customer",
    struct(
        ("c_custkey", _LONG, False),
        ("c_name", _STRING, False),
        ("c_nationkey", _INT, False),
        ("c_acctbal", _DOUBLE, True),
        ("c_mktsegment", _STRING, False),
    ),
    primary_key=("c_custkey",),
    foreign_keys=(ForeignKey(("c_nationkey",), "nation", ("n_nationkey",)),),
)
SUPPLIER = Dataset(
    "supplier",
    struct(
        ("s_suppkey", _LONG, False),
        ("s_name", _STRING, False),
        ("s_nationkey", _INT, False),
        ("s_acctbal", _DOUBLE, True),
    ),
    primary_key=("s_suppkey",),
    foreign_keys=(ForeignKey(("s_nationkey",), "nation", ("n_nationkey",)),),
)
PART = Dataset(
    "part",
    struct(
        ("p_partkey", _LONG, False),
        ("p_name", _STRING, False),
        ("p_brand", _STRING, False),
        ("p_type", _STRING, False),
        ("p_size", _INT, False),
        ("p_retailprice", _DOUBLE, True),
    ),
    primary_key=("p_partkey",),
)
ORDERS = Dataset(
    "orders",
    struct(
        ("o_orderkey", _LONG, False),
        ("o_custkey", _LONG, False),
        ("o_orderstatus", _STRING, False),
        ("o_totalprice", _DOUBLE, True),
        ("o_orderdate", _TIME, False),
        ("o_orderpriority", _STRING, False),
    ),
    primary_key=("o_orderkey",),
    foreign_keys=(ForeignKey(("o_custkey",), "customer", ("c_custkey",)),),
)
LINEITEM = Dataset(
    "lineitem",
    struct(
        ("l_orderkey", _LONG, False),
        ("l_partkey", _LONG, False),
        ("l_suppkey", _LONG, False),
        ("l_linenumber", _INT, False),
        ("l_quantity", _DOUBLE, False),
        ("l_extendedprice", _DOUBLE, False),
        ("l_discount", _DOUBLE, True),
        ("l_tax", _DOUBLE, True),
        ("l_returnflag", _STRING, False),
        ("l_linestatus", _STRING, False),
        ("l_shipdate", _TIME, True),
    ),
    primary_key=("l_orderkey", "l_linenumber"),
    foreign_keys=(
        ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
        ForeignKey(("l_partkey",), "part", ("p_partkey",)),
        ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",)),
    ),
)
EVENTS = Dataset(
    "events",
    struct(
        ("event_id", _LONG, False),
        ("ts", _TIME, False),
        ("user_id", _LONG, False),
        ("event_type", _STRING, False),
        ("value", _DOUBLE, True),
        ("props", _STRING, True),
    ),
    primary_key=("event_id",),
)
DOCUMENTS = Dataset(
    "documents",
    struct(
        ("doc_id", _LONG, False),
        ("text", _STRING, False),
        ("lang", _STRING, False),
        ("source", _STRING, False),
        ("n_chars", _LONG, False),
    ),
    primary_key=("doc_id",),
    multiline=True,
)

# Narrower types and fewer columns than the table has.
LINEITEM_WHOLE_NUMBERS = Dataset(
    "lineitem_whole_numbers",
    struct(
        ("l_orderkey", _INT, False),
        ("l_linenumber", _INT, False),
        ("l_quantity", _INT, False),
        ("l_extendedprice", _INT, False),
        ("l_discount", _STRING, True),
        ("l_shipdate", T.DateType(), True),
        ("l_returnflag", _STRING, False),
    ),
    primary_key=("l_orderkey", "l_linenumber"),
)

RELATIONAL = {
    t.name: t for t in (REGION, NATION, CUSTOMER, SUPPLIER, PART, ORDERS, LINEITEM)
}

# Key and further columns that a CSV file holds as DuckDB prints them.
PLAIN_COLUMNS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
}
