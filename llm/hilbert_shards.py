"""Sharding along a Hilbert curve (operator 4).

Several metadata columns are quantised by their quantiles, the cell's index on
a Hilbert curve orders the documents, and the order is cut into runs of equal
row counts. Neighbours on the curve agree in all columns, so that the files of
a shard hold narrow ranges of each and readers can skip by any of them.

Positions are exact and need no task that sees all rows: narrow rows (no text)
are range-partitioned by curve index and numbered within their partition.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import Scratch, in_order

BITS = 6
DIMENSIONS = ("source", "lang", "n_chars")
ACCURACY = 10_000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of cell numbers (below 2**bits), one column a dimension."""
    x = [c.astype(np.int64).copy() for c in cells.T]
    n, top = len(x), 1 << (bits - 1)
    step = top
    while step > 1:
        low = step - 1
        for i in range(n):
            is_set = (x[i] & step) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap
        step >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    step = top
    while step > 1:
        flips = np.where((x[n - 1] & step) != 0, flips ^ (step - 1), flips)
        step >>= 1
    index = np.zeros_like(flips)
    for bit in reversed(range(bits)):
        for i in range(n):
            index = index << 1 | (x[i] ^ flips) >> bit & 1
    return index


def _string_cuts(df: DataFrame, name: str, bits: int, scratch: Scratch) -> list[str]:
    """The least string of each cell when the distinct ones are dealt evenly, in their order.

    Few strings have a cell each; cell 0 is left to NULL. The driver gets one
    string per cell.
    """
    cells = (1 << bits) - 1
    distinct = df.select(F.col(f"`{name}`").alias("value")).where("value is not null").distinct()
    ranked = in_order(distinct, [F.asc("value")], "place", scratch)
    cell = F.floor(F.col("place") * cells / max(cells, distinct.count()))
    least = ranked.groupBy(cell.alias("cell")).agg(F.min("value").alias("value")).collect()
    return sorted(r.value for r in least)


def with_curve_index(
    df: DataFrame, dimensions: tuple[str, ...], scratch: Scratch, bits: int = BITS
) -> DataFrame:
    """`df` (saved; read several times) with `curve`; NULL and NaN lie in cell 0 of their dimension.

    Numbers are cut at their quantiles, strings at every so many distinct ones.
    """
    texts = [d for d in dimensions if isinstance(df.schema[d].dataType, T.StringType)]
    numbers = {d: F.nanvl(F.col(f"`{d}`").cast("double"), F.lit(None)) for d in dimensions if d not in texts}
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = [F.percentile_approx(c, share, ACCURACY).alias(d) for d, c in numbers.items()]
    cuts = df.agg(F.lit(0), *found).first().asDict()
    cuts |= {d: _string_cuts(df, d, bits, scratch) for d in texts}
    cuts = [sorted(set(cuts[d] or [])) for d in dimensions]

    @F.pandas_udf("long")
    def curve(*columns: pd.Series) -> pd.Series:
        cells = []
        for values, cut in zip(columns, cuts, strict=True):
            known = values.notna().to_numpy()
            kind = object if cut and isinstance(cut[0], str) else np.float64
            own = values[known].to_numpy(kind)
            cells.append(np.zeros(len(values), np.int64))
            cells[-1][known] = np.searchsorted(np.array(cut, kind), own, "right")
        return pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    inputs = [F.col(f"`{d}`") if d in texts else numbers[d] for d in dimensions]
    return df.withColumn("curve", curve(*inputs))


def sharded(
    docs: DataFrame,
    shards: int = 8,
    dimensions: tuple[str, ...] = DIMENSIONS,
    label: str = "hilbert",
) -> DataFrame:
    """(doc_id, size, text_crc32, curve, position, shard, slot) of every row.

    `docs` has doc_id, text and the dimensions. size: bytes of the text plus 1.
    Shards are runs of the curve whose row counts differ by one at most. Equal
    texts have one index, the least of their rows', and are neighbours, ordered
    by a hash of the text and then by doc_id (NULL first): what the equal row
    counts part is the group of equal texts at each of the cuts between shards,
    and one larger than a shard. NULL texts have size 1 and the checksum of the
    empty text, with which they are equal. Repeated rows are rows of their own;
    an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, label)
    raw = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw).alias("text_hash"),
        *[F.col(d) for d in dimensions if d != "doc_id"],
    )
    narrow = scratch.save(narrow)
    columns = ["doc_id", "size", "text_crc32", "text_hash", "curve"]
    placed = scratch.save(with_curve_index(narrow, dimensions, scratch).select(*columns))
    scratch.drop(narrow)
    equal = ["text_hash", "text_crc32", "size"]
    least = placed.groupBy(*equal).agg(F.min("curve").alias("least"), F.count("*").alias("copies"))
    # Written, so that Spark knows the size of what it joins.
    least = scratch.save(least.where("copies > 1").drop("copies"))
    placed = placed.join(least, equal, "left")
    placed = placed.withColumn("curve", F.coalesce("least", "curve")).select(*columns)
    order = [F.col(c) for c in ("curve", "text_hash", "text_crc32", "size", "doc_id")]
    placed = in_order(placed, order, "position", scratch)
    total = placed.count()
    # The first total % shards shards hold a row more than the others.
    small, larger = divmod(total, shards)
    edge = larger * (small + 1)
    after = F.col("position") - edge
    divisor = max(1, small)
    shard = F.when(after < 0, F.floor(F.col("position") / (small + 1))).otherwise(
        larger + F.floor(after / divisor)
    )
    slot = F.when(after < 0, F.col("position") % (small + 1)).otherwise(after % divisor)
    return placed.select(
        *["doc_id", "size", "text_crc32", "curve", "position"],
        shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
    )
