"""SimHash near-duplicates by a self-join of a binary trie (operator 10).

Fingerprints: majority bits over the XXH64 values of word shingles. Links: all
pairs of fingerprints that differ in at most `errors` bits, found without loss:

1. The bits are reordered so that the most even ones lead, then the trie's top
   `split` levels are laid out as subtrees. A pair of subtrees whose prefixes
   differ in at most `errors` bits is one unit of work, so a fingerprint is
   copied to as many units as there are prefixes so near: for 3 errors 15 at 4
   levels, 378 at 13.
2. A unit walks the two subtrees together from their roots. A pair of nodes
   holds the bits in which their prefixes differ; it is dropped as soon as they
   exceed `errors`. Small pairs of nodes are compared outright.
3. Only a spanning forest of a unit's links leaves the task, at most one row
   per fingerprint, and the forests are joined into components.

Equal texts have equal fingerprints and are one entry of the trie, whatever
their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import Scratch, append_columns, fresh, numbered, utf8
from llm.components import components

BITS = 64
# Fingerprints that a subtree should hold at most; the split deepens with the corpus.
SUBTREE_ROWS = 1 << 21
MIN_SPLIT = 4
# Node pairs with at most so many fingerprint pairs are compared outright.
LEAF_PAIRS = 64
# Node pairs, and fingerprint pairs, that a task holds at once.
FRONTIER = 1 << 16
COMPARED = 1 << 21
# Copies of fingerprints that are dealt at once, and tasks that share the units at most.
DEALT = 1 << 16
MOST_TASKS = 1 << 14
# Shingles whose bits are counted at once.
SHINGLE_BLOCK = 1 << 14


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned SimHash; 0 for a text without words."""
    tokens = utf8(text).lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), 42)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(tokens) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    counts, total = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, total, SHINGLE_BLOCK):
        block = zip(starts[at : at + SHINGLE_BLOCK], ends[at : at + SHINGLE_BLOCK], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], 42) for s, e in block], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame, column: str, words: int = 3) -> DataFrame:
    """`docs` with the fingerprint of its text as a signed long in `column`."""

    def factory():
        return lambda texts: [[_signed(fingerprint(t, words)) for t in texts]]

    return append_columns(docs, ["text"], [T.StructField(column, T.LongType())], factory)


def bit_order(fingerprints: DataFrame) -> list[int]:
    """Bit positions (0 is the lowest), the most evenly set ones first."""
    ones = [F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(1)).alias(f"b{i}") for i in range(BITS)]
    row = fingerprints.agg(F.count("*"), *ones).first()
    share = [abs((row[i + 1] or 0) / max(1, row[0]) - 0.5) for i in range(BITS)]
    return sorted(range(BITS), key=lambda i: (share[i], i))


def permuted(values: np.ndarray, order: list[int]) -> np.ndarray:
    """Each value with bit order[0] as its highest bit, order[1] next, and so on."""
    out = np.zeros_like(values)
    one = np.uint64(1)
    for place, bit in enumerate(order):
        out |= (values >> np.uint64(bit) & one) << np.uint64(BITS - 1 - place)
    return out


def prefix_masks(split: int, errors: int) -> np.ndarray:
    """The ways in which two prefixes of `split` bits can differ in at most `errors` bits; 0 first.

    Unit `p * len(masks) + k` is the pair of prefixes p and p ^ masks[k], p being
    the lesser: units are numbered, not listed, however deep the split is.
    """
    sets = [c for k in range(errors + 1) for c in combinations(range(split), k)]
    return np.array([sum(1 << i for i in c) for c in sets], np.int64)


def _leaf_links(a: np.ndarray, b: np.ndarray, nodes: tuple, errors: int) -> Iterator[tuple]:
    """Index pairs within `errors` bits, of all pairs below small node pairs."""
    alo, ahi, blo, bhi = nodes
    width = bhi - blo
    size = (ahi - alo) * width
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        base = ends[start] - size[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + COMPARED, "right")))
        part = slice(start, stop)
        owner = np.repeat(np.arange(start, stop), size[part])
        within = np.arange(len(owner)) - np.repeat(ends[part] - size[part] - base, size[part])
        i = alo[owner] + within // width[owner]
        j = blo[owner] + within % width[owner]
        near = np.bitwise_count(a[i] ^ b[j]) <= errors
        yield i[near], j[near]
        start = stop


def trie_links(a: np.ndarray, b: np.ndarray, errors: int, depth: int = 0) -> Iterator[tuple]:
    """Index pairs (i, j) with a[i] and b[j] within `errors` bits; both sorted, unique, uint64.

    Walks node pairs of the two tries; a node is a range of the sorted array
    whose members agree in their first `level` bits.
    """
    same = a is b
    first = np.array([[0, len(a), 0, len(b)]])
    stack = [(depth, first)]
    while stack:
        level, nodes = stack.pop()
        if len(nodes) > FRONTIER:
            stack += [(level, nodes[i : i + FRONTIER]) for i in range(0, len(nodes), FRONTIER)]
            continue
        alo, ahi, blo, bhi = nodes.T
        above = np.uint64(0) if level == 0 else ~np.uint64((1 << (BITS - level)) - 1)
        spent = np.bitwise_count((a[alo] ^ b[blo]) & above)
        nodes = nodes[(spent <= errors) & ((alo <= blo) | (not same))]
        alo, ahi, blo, bhi = nodes.T
        small = (ahi - alo) * (bhi - blo) <= (LEAF_PAIRS if level < BITS else np.inf)
        if small.any():
            yield from _leaf_links(a, b, tuple(nodes[small].T), errors)
        nodes = nodes[~small]
        if not len(nodes):
            continue
        alo, ahi, blo, bhi = nodes.T
        bit = np.uint64(1 << (BITS - 1 - level))
        keep = ~np.uint64((1 << (BITS - level)) - 1) if level else np.uint64(0)
        amid = np.searchsorted(a, a[alo] & keep | bit)
        bmid = np.searchsorted(b, b[blo] & keep | bit)
        children = []
        for x0, x1 in ((alo, amid), (amid, ahi)):
            for y0, y1 in ((blo, bmid), (bmid, bhi)):
                children.append(np.stack([x0, x1, y0, y1], axis=1)[(x0 < x1) & (y0 < y1)])
        stack.append((level + 1, np.concatenate(children)))


class Forest:
    """Sets of array positions; each set is named by its least member."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            x, y = self.label[i], self.label[j]
            apart = x != y
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (shorter := self.label[self.label] < self.label).any():
                self.label = np.where(shorter, self.label[self.label], self.label)


def unit_edges(a: np.ndarray, b: np.ndarray | None, errors: int, depth: int) -> np.ndarray:
    """Spanning links (rows of two values) of one unit; `b` is None for a subtree with itself."""
    values = a if b is None else np.concatenate([a, b])
    forest = Forest(len(values))
    if b is not None and not (len(a) and len(b)):
        return np.empty((0, 2), np.uint64)
    for i, j in trie_links(a, a if b is None else b, errors, depth if b is None else 0):
        forest.link(i, j if b is None else j + len(a))
    joined = np.flatnonzero(forest.label != np.arange(len(values)))
    return np.stack([values[joined], values[forest.label[joined]]], axis=1)


def fingerprint_links(fingerprints: DataFrame, errors: int = 3) -> DataFrame:
    """Links (a, b) that connect what the pairs within `errors` bits connect.

    `fingerprints` holds distinct `fp` and is read three times; pass a saved table.
    """
    count = fingerprints.count()
    split = max(MIN_SPLIT, math.ceil(math.log2(max(1, count) / SUBTREE_ROWS)))
    order = bit_order(fingerprints)
    masks = prefix_masks(split, errors)
    shift = np.uint64(BITS - split)
    # A unit per mask and prefix, where a pair of prefixes is met from both.
    pairs = (1 << split) * (len(masks) + 1) // 2

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, DEALT // len(masks))
        for batch in batches:
            values = permuted(batch.column(0).to_numpy().view(np.uint64), order)
            for at in range(0, len(values), step):
                part = values[at : at + step]
                prefix = (part >> shift).astype(np.int64)[:, None]
                unit = np.minimum(prefix, prefix ^ masks) * len(masks) + np.arange(len(masks))
                copies = np.repeat(part, len(masks)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit.reshape(-1)), pa.array(copies)], names=["unit", "value"]
                )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inverse = [BITS - 1 - order.index(bit) for bit in reversed(range(BITS))]
        for unit, values in _by_unit(batches):
            values = np.unique(values)
            p, k = divmod(unit, len(masks))
            if k == 0:
                edges = unit_edges(values, None, errors, split)
            else:
                cut = int(np.searchsorted(values >> shift, np.uint64(p ^ int(masks[k]))))
                edges = unit_edges(values[:cut], values[cut:], errors, 0)
            back = permuted(edges.reshape(-1), inverse).view(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(back[:, 0]), pa.array(back[:, 1])], names=["a", "b"]
            )

    dealt = fingerprints.select("fp").mapInArrow(deal, "unit long, value long")
    dealt = dealt.repartitionByRange(min(pairs, MOST_TASKS), "unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(walk, "a long, b long")


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Each unit with its values; rows come ordered by unit."""
    held: list[np.ndarray] = []
    current = None
    for batch in batches:
        unit = batch.column(0).to_numpy()
        values = batch.column(1).to_numpy().view(np.uint64)
        for at in np.split(np.arange(len(unit)), np.flatnonzero(np.diff(unit)) + 1):
            if len(at):
                if current is not None and unit[at[0]] != current:
                    yield current, np.concatenate(held)
                    held = []
                current = int(unit[at[0]])
                held.append(values[at])
    if held:
        yield current, np.concatenate(held)


def near_duplicates(docs: DataFrame, errors: int = 3, words: int = 3) -> DataFrame:
    """(row, doc_id, fp, component_id, keep) of `docs` (row, doc_id, text).

    `row` numbers the rows of `docs`, each once. component_id is the least
    doc_id among all documents that links lead to; rows without doc_id take
    part and get the least id of their component, NULL if it has none. `keep`
    marks one row per component: that of the least doc_id, of equal or missing
    ids the least row. NULL, empty and blank texts have fingerprint 0 and are
    duplicates of each other. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = with_fingerprints(docs.select("row", "doc_id", "text"), "fp", words)
    rows = scratch.save(rows.select("row", "doc_id", "fp"))
    distinct = scratch.save(rows.select("fp").distinct())
    groups = components(fingerprint_links(distinct, errors), scratch)
    groups = distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )
    first = F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "row")).alias("first")
    by_fp = rows.groupBy("fp").agg(first).join(groups, "fp")
    groups = scratch.save(by_fp.select("fp", "component", "first"))
    least = groups.groupBy("component").agg(F.min("first").alias("least"))
    named = groups.join(least, "component").select("fp", "least")
    return rows.join(named, "fp").select(
        "row",
        "doc_id",
        "fp",
        F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("keep"),
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """The documents that `near_duplicates` keeps, with all their columns."""
    row = fresh(docs, "row")
    listed = numbered(docs, row)
    marked = near_duplicates(listed.select(F.col(row).alias("row"), "doc_id", "text"))
    kept = marked.where("keep").select(F.col("row").alias(row))
    return listed.join(kept, row, "left_semi").select(*docs.columns)
