"""Dataset contracts: what a table must look like, where it lives, how it is written."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from millrace.errors import ContractError
from millrace.functions.columns import standard_name


@dataclass(frozen=True)
class ForeignKey:
    """`columns` of a dataset must occur as `parent_columns` of dataset `parent`."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Dataset:
    """One table's contract.

    `required` columns must not hold NULL; left at None it follows the
    schema's NOT NULL marks. `multiline` is for CSV whose quoted text contains
    line breaks, which is refused unless declared. With `keep_files` the source's
    files are landed byte for byte and under their names, not their rows anew.
    """

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    required: tuple[str, ...] | None = None
    foreign_keys: tuple[ForeignKey, ...] = ()
    source_path: str = ""
    bronze_path: str = ""
    silver_path: str = ""
    file_format: str = "csv"
    multiline: bool = False
    keep_files: bool = False
    write_format: str = "parquet"
    write_mode: str = "overwrite"
    compression: str = "snappy"
    partition_columns: tuple[str, ...] = ()
    drop_duplicates: bool = True
    version: tuple[str, ...] = ()

    @property
    def required_columns(self) -> tuple[str, ...]:
        if self.required is not None:
            return self.required
        return tuple(f.name for f in self.schema.fields if not f.nullable)

    def conformed(self) -> Dataset:
        """The contract of the conformed table, whose columns have standard names."""
        named = lambda names: tuple(standard_name(n) for n in names)
        fields = [
            T.StructField(standard_name(f.name), f.dataType, f.nullable) for f in self.schema.fields
        ]
        links = tuple(replace(k, columns=named(k.columns)) for k in self.foreign_keys)
        return replace(
            self,
            schema=T.StructType(fields),
            primary_key=named(self.primary_key),
            required=None if self.required is None else named(self.required),
            partition_columns=named(self.partition_columns),
            version=named(self.version),
            foreign_keys=links,
        )


def struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    """Schema from (name, type, nullable) triples."""
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def lookup(registry: Mapping[str, Dataset], name: str) -> Dataset:
    """The contract called `name`; unknown names list the known ones."""
    if name not in registry:
        raise ContractError(f"unknown dataset '{name}', known: {', '.join(sorted(registry))}")
    return registry[name]


def select_datasets(
    registry: Mapping[str, Dataset], names: str | Iterable[str] = "all"
) -> list[Dataset]:
    """Contracts for `names` (or every one, in registry order, for "all")."""
    if names == "all":
        return list(registry.values())
    wanted = [names] if isinstance(names, str) else list(names)
    return [lookup(registry, n) for n in wanted]


_INT, _DOUBLE, _STRING = T.IntegerType(), T.DoubleType(), T.StringType()

# Columns, types, nullability, keys and references of the six
# retail tables.
_AISLES = struct(
    ("aisle_id", _INT, False),
    ("aisle", _STRING, False),
)
_DEPARTMENTS = struct(
    ("department_id", _INT, False),
    ("department", _STRING, False),
)
_PRODUCTS = struct(
    ("product_id", _INT, False),
    ("product_name", _STRING, False),
    ("aisle_id", _INT, False),
    ("department_id", _INT, False),
)
_ORDERS = struct(
    ("order_id", _INT, False),
    ("user_id", _INT, False),
    ("eval_set", _STRING, False),
    ("order_number", _INT, False),
    ("order_dow", _INT, False),
    ("order_hour_of_day", _INT, False),
    # NULL for a user's first order, hence not a required column.
    ("days_since_prior_order", _DOUBLE, True),
)
_ORDER_PRODUCTS = struct(
    ("order_id", _INT, False),
    ("product_id", _INT, False),
    ("add_to_cart_order", _INT, False),
    ("reordered", _INT, False),
)
_ORDER_PRODUCT_REFERENCES = (
    ForeignKey(("order_id",), "orders", ("order_id",)),
    ForeignKey(("product_id",), "products", ("product_id",)),
)


def retail_datasets(root: str, source_root: str) -> dict[str, Dataset]:
    """The six retail tables with their layers below `root` (any Hadoop URI)."""

    def make(name: str, schema: T.StructType, key: tuple[str, ...], *refs: ForeignKey) -> Dataset:
        return Dataset(
            name=name,
            schema=schema,
            primary_key=key,
            foreign_keys=refs,
            source_path=f"{source_root}/{name}.csv",
            bronze_path=f"{root}/bronze/{name}",
            silver_path=f"{root}/silver/{name}",
        )

    tables = [
        make("aisles", _AISLES, ("aisle_id",)),
        make("departments", _DEPARTMENTS, ("department_id",)),
        make(
            "products",
            _PRODUCTS,
            ("product_id",),
            ForeignKey(("aisle_id",), "aisles", ("aisle_id",)),
            ForeignKey(("department_id",), "departments", ("department_id",)),
        ),
        make("orders", _ORDERS, ("order_id",)),
        make(
            "order_products__prior",
            _ORDER_PRODUCTS,
            ("order_id", "product_id"),
            *_ORDER_PRODUCT_REFERENCES,
        ),
        make(
            "order_products__train",
            _ORDER_PRODUCTS,
            ("order_id", "product_id"),
            *_ORDER_PRODUCT_REFERENCES,
        ),
    ]
    return {t.name: t for t in tables}
