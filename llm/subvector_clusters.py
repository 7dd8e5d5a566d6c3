"""K-means over subvector dictionaries (operator 11).

Vectors become integers, and blocks of neighbouring components are encoded,
without loss, as codes into a dictionary of the distinct subvectors of a block.
A round computes the exact distance of each dictionary entry from each centroid
once and adds these partial distances up by code; the sums for the new centroids
come from the counts of the codes in the same way. Everything is integer.

A dictionary covers a chunk of at most CHUNK vectors, which one task holds; the
encoded chunks are written once, and each round is a pass over them without a
shuffle of vectors. What leaves a task is a sum per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import Scratch

SCALE = 256
WIDTH = 2
CHUNK = 1 << 13
# Scaled components beyond this are held at it, so that no sum of squares overflows.
MOST = 1 << 26

ENCODED = "ids array<long>, sizes array<int>, entries array<int>, codes array<int>"


def _usable(embedding: Column, dimensions: int) -> Column:
    """Whether a vector has exactly so many components, none NULL or non-finite."""
    odd = F.exists(
        embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.coalesce((F.size(embedding) == dimensions) & ~odd, F.lit(False))


def _scaled(components: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(components.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int32)


def _encode(ids: list, vectors: np.ndarray, width: int) -> list:
    sizes, entries, codes = [], [], []
    for first in range(0, vectors.shape[1], width):
        distinct, code = np.unique(vectors[:, first : first + width], axis=0, return_inverse=True)
        sizes.append(len(distinct))
        entries.append(distinct.ravel())
        codes.append(code.ravel())
    return [ids, sizes, np.concatenate(entries), np.concatenate(codes)]


def encoded(vectors: DataFrame, dimensions: int, width: int = WIDTH) -> DataFrame:
    """The usable vectors of (vec_id, embedding) as chunks: ids, dictionaries and codes."""
    schema = pa.schema(
        [
            ("ids", pa.list_(pa.int64())),
            *[(n, pa.list_(pa.int32())) for n in ("sizes", "entries", "codes")],
        ]
    )

    def chunk(ids: list, parts: list) -> pa.RecordBatch:
        columns = _encode(ids, np.concatenate(parts), width)
        arrays = [pa.array([c], f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                if len(ids) + part.num_rows > CHUNK and ids:
                    yield chunk(ids, parts)
                    ids, parts = [], []
                ids = ids + part.column(0).to_pylist()
                parts.append(_scaled(flat).reshape(-1, dimensions))
        if ids:
            yield chunk(ids, parts)

    kept = vectors.where(_usable(F.col("embedding"), dimensions))
    return kept.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, ENCODED)


class Chunk:
    """One row of the encoded table."""

    def __init__(self, batch: pa.RecordBatch, row: int, dimensions: int, width: int):
        ids, sizes, entries, codes = (batch.column(i)[row].values for i in range(4))
        self.ids, self.blocks = ids, []
        entries, codes, n = entries.to_numpy(), codes.to_numpy(), len(ids)
        at = 0
        for block, size in enumerate(sizes.to_pylist()):
            wide = min(width, dimensions - block * width)
            distinct = entries[at : at + size * wide].reshape(size, wide).astype(np.int64)
            self.blocks.append((distinct, codes[block * n : (block + 1) * n]))
            at += size * wide

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each vector, and the squared distance."""
        total = np.zeros((len(self.ids), len(centroids)), np.int64)
        first = 0
        for distinct, codes in self.blocks:
            block = centroids[:, first : first + distinct.shape[1]]
            apart = ((distinct[:, None, :] - block[None, :, :]) ** 2).sum(axis=2)
            total += apart[codes]
            first += distinct.shape[1]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(cluster)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Per cluster: the number of its vectors, then the sum of each component."""
        columns = [np.bincount(cluster, minlength=k)[:, None]]
        for distinct, codes in self.blocks:
            size = len(distinct)
            counts = np.bincount(cluster * size + codes, minlength=k * size).reshape(k, size)
            columns.append(counts @ distinct)
        return np.concatenate(columns, axis=1)


def _sums(chunks: DataFrame, centroids: np.ndarray, dimensions: int, width: int) -> dict:
    """(cluster, 0) to its size, (cluster, i) to the sum of its component i - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), dimensions + 1), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row, dimensions, width)
                total += chunk.sums(chunk.nearest(centroids)[0], len(centroids))
        cluster, place = np.nonzero(total)
        columns = [cluster.astype(np.int32), place.astype(np.int32), total[cluster, place]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["cluster", "place", "value"]
        )

    parts = chunks.mapInArrow(run, "cluster int, place int, value long")
    found = parts.groupBy("cluster", "place").agg(F.sum("value").alias("value"))
    return {(r.cluster, r.place): r.value for r in found.collect()}


def _assigned(chunks: DataFrame, centroids: np.ndarray, dimensions: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row, dimensions, width)
                cluster, distance = chunk.nearest(centroids)
                columns = [chunk.ids, pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return chunks.mapInArrow(run, "vec_id long, cluster int, distance long")


def _starts(vectors: DataFrame, k: int, dimensions: int, seed: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    kept = vectors.where(_usable(F.col("embedding"), dimensions))
    kept = kept.select("embedding", order.alias("order"))
    first = kept.orderBy(F.col("order").asc_nulls_last(), "embedding").limit(k).collect()
    rows = [_scaled(np.array(r.embedding, np.float64)) for r in first]
    return np.array(rows, np.int64).reshape(-1, dimensions)


def clustered(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dimensions: int = 64,
    seed: int = 2,
    width: int = WIDTH,
    label: str = "subvectors",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per usable vector.

    `vectors` has vec_id and embedding; other columns are ignored. Vectors that
    are NULL, of another length or hold NULL or non-finite components have no
    row. A component x counts as floor(256 * x), held within 2**26 either way.
    Centroids start as the k vectors of the smallest sha256 of `seed:vec_id`;
    vectors without an id come last there, equal ids in the order of their
    components. Repeated rows are rows of their own and fewer than k vectors
    start fewer centroids. An empty table gives no rows. The driver holds the
    centroids and a sum per centroid and component.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, label)
    centroids = _starts(vectors, k, dimensions, seed)
    chunks = scratch.save(encoded(vectors, dimensions, width))
    for _ in range(rounds):
        sums = _sums(chunks, centroids, dimensions, width)
        moved = centroids.copy()
        for c in range(len(centroids)):
            if size := sums.get((c, 0), 0):
                moved[c] = [sums.get((c, i + 1), 0) // size for i in range(dimensions)]
        if (moved == centroids).all():
            break
        centroids = moved
    found = scratch.save(_assigned(chunks, centroids, dimensions, width))
    scratch.drop(chunks)
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r.cluster: r.total for r in found.groupBy("cluster").agg(wide.alias("total")).collect()}
    top = (1 << 63) - 1
    every = min(top, int(sum(inertia.values())))
    rows = [
        (c, min(top, int(total)), every, _digest(centroids[c])) for c, total in inertia.items()
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    facts = spark.createDataFrame(rows, schema)
    return found.join(F.broadcast(facts), "cluster").select(
        *["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    )


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
