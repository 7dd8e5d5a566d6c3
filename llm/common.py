"""Helpers that the operators share: tables, folds, scratch tables, appended columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.session import drop_path, scratch_path

# Rows handled at once inside a Python task; bounds what a batch of long texts holds.
SLICE_ROWS = 256
SLICE_BYTES = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(id_column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a NULL id is in no fold."""
    fold = F.crc32(F.col(id_column).cast("string")) % modulus == remainder
    return F.coalesce(fold, F.lit(False))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, column: str) -> DataFrame:
    """`docs` with a number of its own per row, the same whenever the same files are read."""
    return docs.withColumn(column, F.monotonically_increasing_id())


class Scratch:
    """Tables below the cluster's shared folder that cut lineage and outlive an executor.

    They stay as long as a returned frame may read them; what is only needed on
    the way is removed with `drop`.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.count = spark, scratch_path(spark, label), 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._scratch = path
        return saved

    def drop(self, df: DataFrame) -> None:
        drop_path(self.spark, df._scratch)


def in_order(df: DataFrame, order: Sequence[Column], name: str, scratch: Scratch) -> DataFrame:
    """`df` with each row's place, from 0, in an order that no task sees as a whole.

    Rows are range-partitioned and numbered within their partition in a scratch
    table; a partition starts at the sum of the sizes before it, a number each.
    """
    at, part, first = (fresh(df, n) for n in ("at", "part", "first"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # The id holds the partition's number above 33 bits and the row's number in it below.
    placed = scratch.save(placed.withColumn(at, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(at, 33))
    sizes = sorted(placed.groupBy(part).count().collect())
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    starts = df.sparkSession.createDataFrame(starts, f"`{part}` long, `{first}` long")
    placed = placed.join(F.broadcast(starts), part)
    place = F.col(first) + F.col(at).bitwiseAND((1 << 33) - 1)
    return placed.select(*df.columns, place.alias(name))


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS
) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `rows` rows, and of about SLICE_BYTES."""
    for batch in batches:
        fit = batch.num_rows * SLICE_BYTES // max(1, batch.nbytes)
        step = max(1, min(rows, fit))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def append_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[T.StructField],
    factory: Callable[[], Callable[..., Sequence[Sequence]]],
) -> DataFrame:
    """`df` with further columns, computed slice by slice in Arrow batches.

    `factory` runs once per task and gives the function from the input columns
    (lists) to the new columns.
    """
    schema = T.StructType([*df.schema.fields, *fields])
    at = [df.columns.index(c) for c in inputs]
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = factory()
        for part in slices(batches):
            new = function(*[part.column(i).to_pylist() for i in at])
            columns = [pa.array(c, k) for c, k in zip(new, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=names)

    return df.mapInArrow(run, schema)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
