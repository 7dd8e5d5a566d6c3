"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables (operator 1).

A rotation is learned (centring, principal axes, iterative quantisation) whose
signs are balanced binary codes. A code is cut into chunks, each the key of a
hash table; candidates share a bucket and are then compared by their original
vectors, in double precision.

The search misses nothing. Unit vectors with cosine c lie at squared distance
2 - 2c, and a rotated projection never lengthens it, so that of all chunks one
has at most an equal part of it. A bit of that chunk differs only if the
distance spans both projections' gaps to zero, so one of the two vectors has
gaps whose squares, over the differing bits, sum to at most half that part. Each
vector is therefore looked up under its own chunk and under those reached by
flipping bits of such small gaps.

Vectors that meet in a bucket are compared inside a task, block by block, so
that a bucket of any size is spread over tasks. A pair that meets several times
counts once, where it meets first. Per vector, its number of links and one
parent in a spanning forest leave the task; pairs never do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import Scratch, append_columns, numbered
from llm.components import components
from llm.simhash_trie import Forest

CODE_BITS = 64
CHUNKS = 4
ROUNDS = 30
# Vectors that the rotation is learned from, at most; all are indexed.
FIT_ROWS = 20_000
SEED = 1
# Slack for rounding in projections and norms.
SLACK = 1e-6
# Whole number that stands for the greatest squared distance that flipped bits may span.
MOST = 60_000
# Vectors of a bucket that one block holds, and pairs compared at once.
BLOCK_ROWS = 2048
COMPARED = 1 << 18


class Rotation:
    """Centre and projection to code bits, learned from unit vectors (rows)."""

    def __init__(self, sample: np.ndarray, bits: int = CODE_BITS, rounds: int = ROUNDS):
        n, width = sample.shape
        self.width, bits = width, min(bits, width)
        self.centre = sample.mean(axis=0) if n else np.zeros(width)
        centred = sample - self.centre
        axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
        rng = np.random.Generator(np.random.PCG64(SEED))
        turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
        flat = centred @ axes
        for _ in range(rounds if n else 0):
            signs = np.where(flat @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(flat.T @ signs)
            turn = left @ right
        self.matrix = axes @ turn

    def project(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.centre) @ self.matrix


def chunk_edges(bits: int, chunks: int = CHUNKS) -> list[tuple[int, int]]:
    cuts = [round(i * bits / chunks) for i in range(chunks + 1)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def flips(costs: list[int]) -> list[int]:
    """Masks of bit sets whose costs sum to at most MOST; the empty one is included."""
    order = sorted(range(len(costs)), key=lambda i: costs[i])
    found, stack = [], [(0, 0, 0)]
    while stack:
        at, mask, spent = stack.pop()
        found.append(mask)
        for i in range(at, len(order)):
            if spent + costs[order[i]] > MOST:
                break
            stack.append((i + 1, mask | 1 << order[i], spent + costs[order[i]]))
    return found


def unit_vector(vector: list | None) -> list[float] | None:
    """The vector over its length; None unless all components are finite and one is not zero."""
    if not vector or any(x is None for x in vector):
        return None
    values = np.array(vector, float)
    if not np.isfinite(values).all() or not values.any():
        return None
    values = values / np.abs(values).max()
    return (values / np.linalg.norm(values)).tolist()


def classes(vectors: DataFrame) -> DataFrame:
    """(label, e, members, least, unit, node) of the distinct vectors `e` that can link."""
    double = F.col("embedding").cast("array<double>")
    rows = vectors.where(F.col("label").isNotNull()).select("vec_id", "label", double.alias("e"))
    rows = rows.groupBy("label", "e")
    rows = rows.agg(F.count("*").alias("members"), F.min("vec_id").alias("least"))
    field = T.StructField("unit", T.ArrayType(T.DoubleType()))
    rows = append_columns(rows, ["e"], [field], lambda: lambda e: [[unit_vector(x) for x in e]])
    return numbered(rows.where(F.col("unit").isNotNull()), "node")


def learned(known: DataFrame) -> Rotation:
    """The rotation, from at most FIT_ROWS vectors of `known`, those of the least hash."""
    widest = known.agg(F.max(F.size("unit"))).first()[0] or 1
    drawn = known.orderBy(F.xxhash64("node"), "node").limit(FIT_ROWS).select("unit")
    return Rotation(_padded([r["unit"] for r in drawn.collect()], widest))


def _padded(rows: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def coded(known: DataFrame, rotation: Rotation, most: float) -> DataFrame:
    """`known` with its unit vector as bytes, its code, and the cost of flipping each bit.

    Costs are squared gaps, rounded down to whole numbers of which MOST stands
    for `most`: their sums do not depend on the order, and no flip is lost.
    """

    def factory():
        def function(units):
            projected = rotation.project(_padded(units, rotation.width))
            places = np.uint64(1) << np.arange(projected.shape[1], dtype=np.uint64)
            codes = ((projected >= 0) * places).sum(axis=1, dtype=np.uint64)
            costs = np.minimum(np.floor(projected**2 / most * MOST), MOST + 1).astype("<u2")
            raw = [np.array(u, "<f8").tobytes() for u in units]
            return raw, codes.view(np.int64).tolist(), [c.tobytes() for c in costs]

        return function

    fields = T.StructType.fromDDL("raw binary, code long, costs binary").fields
    return append_columns(known, ["unit"], fields, factory)


def table_keys(codes: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """(node, width, label, table, key, own): the buckets that each vector is looked up in.

    `own` marks the bucket of its own chunk, one per table.
    """

    def factory():
        def function(code, costs):
            tables, keys = [], []
            for c, raw in zip(code, costs, strict=True):
                cost = np.frombuffer(raw, "<u2").tolist()
                found = []
                for number, (start, end) in enumerate(edges):
                    chunk = c >> start & (1 << (end - start)) - 1
                    found += [(number, chunk ^ mask) for mask in flips(cost[start:end])]
                tables.append([number for number, _ in found])
                keys.append([key for _, key in found])
            return tables, keys

        return function

    fields = T.StructType.fromDDL("tables array<int>, keys array<long>").fields
    narrow = codes.select("node", "label", F.size("unit").alias("width"), "code", "costs")
    found = append_columns(narrow, ["code", "costs"], fields, factory)
    found = found.select("node", "label", "width", "code", F.inline(F.arrays_zip("tables", "keys")))
    found = found.withColumnsRenamed({"tables": "table", "keys": "key"})
    starts = F.array(*[F.lit(start) for start, _ in edges])
    masks = F.array(*[F.lit((1 << (end - start)) - 1) for start, end in edges])
    chunk = F.expr("shiftrightunsigned(code, start)").bitwiseAND(F.col("mask"))
    found = found.withColumns({"start": F.get(starts, "table"), "mask": F.get(masks, "table")})
    return found.withColumn("own", F.col("key") == chunk).drop("code", "start", "mask")


def bucket_blocks(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, table, bucket, i, j, home): who is compared with whom; `keys` is saved.

    In a bucket the vectors whose own chunk it is (homes) meet all that are
    looked up in it. A large bucket is cut into blocks of about BLOCK_ROWS by a
    hash, and each pair of blocks is a unit of work (bucket, i, j). Buckets that
    hold one vector, or no home, are left out before vectors are moved.
    """
    name = ["label", "width", "table", "key"]
    sizes = keys.groupBy(*name).agg(F.count_if("own").alias("homes"), F.count("*").alias("all"))
    sizes = scratch.save(numbered(sizes.where((F.col("homes") > 0) & (F.col("all") > 1)), "bucket"))
    placed = keys.join(sizes, name).select(
        *["node", "table", "bucket", "own"],
        F.ceil(F.col("homes") / BLOCK_ROWS).cast("int").alias("rows"),
        F.ceil(F.col("all") / BLOCK_ROWS).cast("int").alias("columns"),
    )
    mine = {c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int") for c in ("rows", "columns")}

    def unit(i, j, home: bool):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(home).alias("home"))

    across = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda j: unit(mine["rows"], j, True))
    down = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: unit(i, mine["columns"], False))
    units = F.when(F.col("own"), F.concat(across, down)).otherwise(down)
    return placed.select("node", "table", "bucket", F.inline(units))


class Block:
    """Vectors of one side of a unit of work."""

    def __init__(self, frame: pa.Table):
        self.node = frame["node"].to_numpy()
        self.members = frame["members"].to_numpy()
        self.unit = np.frombuffer(b"".join(frame["raw"].to_pylist()), "<f8").reshape(len(frame), -1)
        costs = np.frombuffer(b"".join(frame["costs"].to_pylist()), "<u2")
        self.costs = costs.reshape(len(frame), -1).astype(np.int32)
        places = np.arange(self.costs.shape[1], dtype=np.uint64)
        code = frame["code"].to_numpy().view(np.uint64)
        self.bits = (code[:, None] >> places & np.uint64(1)).astype(bool)


def met_before(homes: Block, others: Block, i, j, table: int, edges: list) -> np.ndarray:
    """Whether pairs (i of `homes`, j of `others`) also meet in a unit that counts before this one.

    A pair meets in a table if either vector is looked up under the other's own
    chunk. It counts in the first such table, and there, if both are, under the
    chunk of the lesser node.
    """
    seen = np.zeros(len(i), bool)
    for number in range(table + 1):
        start, end = edges[number]
        differ = homes.bits[i, start:end] != others.bits[j, start:end]
        reached = (differ * homes.costs[i, start:end]).sum(axis=1) <= MOST
        if number == table:
            seen |= reached & (homes.node[i] > others.node[j])
        else:
            seen |= reached | ((differ * others.costs[j, start:end]).sum(axis=1) <= MOST)
    return seen


def unit_links(
    homes: Block, others: Block, table: int, cosine: float, edges: list
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions that link and count in this unit, in parts of bounded size."""
    step = max(1, COMPARED // max(1, len(others.node)))
    for at in range(0, len(homes.node), step):
        products = homes.unit[at : at + step] @ others.unit.T
        i, j = np.nonzero(products >= cosine - 1e-9)
        near, i = products[i, j] < cosine + 1e-9, i + at
        keep = homes.node[i] != others.node[j]
        # At the threshold the sum is taken in one fixed order.
        exact = (homes.unit[i[near]] * others.unit[j[near]]).sum(axis=1) >= cosine
        keep[np.flatnonzero(near)[~exact]] = False
        i, j = i[keep], j[keep]
        first = ~met_before(homes, others, i, j, table, edges)
        yield i[first], j[first]


def linked(units: DataFrame, cosine: float, edges: list[tuple[int, int]]) -> DataFrame:
    """(node, links, parent) per unit of work and vector with links that count there.

    `links` adds up the members of the vectors it links to. The parents make a
    spanning forest of the unit's links, so that no pairs leave a task.
    """

    def compare(part: pa.Table) -> pa.RecordBatch:
        home = part["home"].to_numpy()
        homes, others = (Block(part.filter(pa.array(h))) for h in (home, ~home))
        nodes = np.unique(np.concatenate([homes.node, others.node]))
        at, to = np.searchsorted(nodes, homes.node), np.searchsorted(nodes, others.node)
        links, forest = np.zeros(len(nodes)), Forest(len(nodes))
        for i, j in unit_links(homes, others, part["table"][0].as_py(), cosine, edges):
            links += np.bincount(at[i], others.members[j], len(nodes))
            links += np.bincount(to[j], homes.members[i], len(nodes))
            forest.link(at[i], to[j])
        some = np.flatnonzero(links)
        columns = [nodes[some], links[some].astype(np.int64), nodes[forest.label[some]]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            unit = np.stack([batch[c].to_numpy() for c in ("bucket", "i", "j")], axis=1)
            edge = np.flatnonzero((np.diff(unit, axis=0) != 0).any(axis=1)) + 1
            for start, stop in zip([0, *edge], [*edge, len(unit)], strict=True):
                if stop > start:
                    if held and tuple(unit[start]) != current:
                        yield compare(pa.Table.from_batches(held))
                        held = []
                    current = tuple(unit[start])
                    held.append(batch.slice(start, stop - start))
        if held:
            yield compare(pa.Table.from_batches(held))

    schema = T.StructType.fromDDL("node long, links long, parent long")
    unit = ["bucket", "i", "j"]
    ordered = units.repartition(*unit).sortWithinPartitions(*unit)
    return ordered.mapInArrow(run, schema)


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `vectors` (vec_id, embedding, label).

    Vectors link if their labels are equal and not NULL, they have equally many
    components and their cosine is at least `cosine`. Equal vectors of a label
    are one entry of the tables, whatever their number, and link to each other.
    NULL, empty and zero vectors and such with NULL or non-finite components
    link with nothing: no links, and their own id as component. Rows that
    repeat an id are vectors of their own. component_id is the least id that is
    not NULL among all that links lead to. An empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "itq")
    known = scratch.save(classes(vectors))
    rotation = learned(known)
    edges = chunk_edges(rotation.matrix.shape[1])
    most = (2 - 2 * cosine + SLACK) / len(edges) / 2
    codes = scratch.save(coded(known, rotation, most))
    keys = scratch.save(table_keys(codes, edges))
    units = bucket_blocks(keys, scratch)
    units = units.join(codes.select("node", "members", "raw", "code", "costs"), "node")
    found = scratch.save(linked(units, cosine, edges))
    forest = found.where(F.col("node") != F.col("parent"))
    groups = components(forest.select(F.col("node").alias("a"), F.col("parent").alias("b")), scratch)
    others = found.groupBy("node").agg(F.sum("links").alias("others"))
    marked = known.join(groups, "node", "left").join(others, "node", "left")
    marked = marked.withColumn("component", F.coalesce("component", "node"))
    marked = scratch.save(marked.select("label", "e", "members", "others", "component", "least"))
    least = marked.groupBy("component").agg(F.min("least").alias("component_id"))
    marked = marked.join(least, "component").select(
        *["label", "e", "component_id"],
        (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    double = F.col("embedding").cast("array<double>").alias("e")
    # Only labelled, usable vectors have an entry.
    rows = vectors.select("vec_id", "label", double)
    found = rows.join(marked, ["label", "e"], "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
