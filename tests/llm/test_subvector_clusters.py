"""K-means over subvector dictionaries against a plain version and DuckDB."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pytest

from llm import subvector_clusters
from llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, cluster string, codes int"


def plain(rows, k, rounds, seed=2):
    """(id, cluster, distance) of each vector, and the centroids."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    digest = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (digest[r], kept[r][1]))
    centroids = [kept[r][1] for r in order[:k]]

    def nearest(v):
        apart = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return apart.index(min(apart)), min(apart)

    for _ in range(rounds):
        at = [nearest(v)[0] for _, v in kept]
        for c in range(len(centroids)):
            own = [v for a, (_, v) in zip(at, kept, strict=True) if a == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted((i, *nearest(v)) for i, v in kept), centroids


def test_query_equals_oracle(spark):
    name = "op11_subvector_clusters"
    found = QUERIES[name](spark, SF)
    assert differences(found, connect(SF), ORACLES[name]) == ""


@pytest.mark.parametrize("width", [1, 2, 3, 7])
def test_equals_plain_kmeans(spark, width):
    rng = np.random.default_rng(5)
    # Few distinct values: subvectors repeat, and distances tie.
    rows = [(i, (rng.integers(-3, 3, 7) / 256).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 400)] + [(0, rows[0][1]), (7, rows[9][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = subvector_clusters.clustered(df, k=9, rounds=4, dimensions=7, width=width).toPandas()
    expected, centroids = plain(rows, 9, 4)
    got = found[["vec_id", "cluster", "distance"]].sort_values(["vec_id", "cluster"])
    assert list(got.itertuples(index=False, name=None)) == expected
    assert (found.inertia == sum(d for _, _, d in expected)).all()
    for c, own in found.groupby("cluster"):
        assert set(own.cluster_inertia) == {own.distance.sum()}
        text = ",".join(map(str, centroids[c]))
        assert set(own.centroid_sha256) == {hashlib.sha256(text.encode()).hexdigest()}


def test_dictionaries_lose_nothing(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    batches = subvector_clusters.encoded(df, 64, 3).toArrow().to_batches()
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    seen = 0
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = subvector_clusters.Chunk(batch, row, 64, 3)
            whole = np.concatenate([d[c] for d, c in chunk.blocks], axis=1)
            for i, vector in zip(chunk.ids.to_pylist(), whole.tolist(), strict=True):
                assert vector == [math.floor(256 * x) for x in vectors[i]]
                seen += 1
    assert seen == len(vectors)


def test_chunks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(subvector_clusters, "CHUNK", 64)
    df = spark.read.parquet(f"{SF}/embeddings.parquet").coalesce(1)
    sizes = [len(r.ids) for r in subvector_clusters.encoded(df, 64).collect()]
    assert sum(sizes) == 500 and max(sizes) <= 64


def test_odd_rows(spark):
    one, nan, inf = [0.5] * 64, float("nan"), float("inf")
    rows = [
        (1, None, "a", 1),
        (2, [], "a", 1),
        (3, one[:63], None, None),
        (4, [*one[:63], None], "a", 1),
        (5, [*one[:63], nan], "a", 1),
        (6, [*one[:63], -inf], "a", 1),
        (None, one, "a", 1),
        (None, one, "a", 1),
        (8, [0.0] * 64, "a", None),
        (9, [1e300, *[-1e300] * 63], "a", 1),
    ]
    found = subvector_clusters.clustered(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert found.vec_id.isna().sum() == 2
    assert sorted(found.vec_id.dropna()) == [8, 9]
    # Each vector is a centroid; equal ones go to the one of the smaller number.
    assert (found.distance == 0).all() and found.cluster.nunique() == 3
    empty = spark.createDataFrame([], SCHEMA)
    assert subvector_clusters.clustered(empty).count() == 0
    unusable = spark.createDataFrame(rows[:6], SCHEMA)
    assert subvector_clusters.clustered(unusable).count() == 0


def test_every_usable_vector_of_the_query(spark):
    found = QUERIES["op11_subvector_clusters"](spark, SF).toPandas()
    assert sorted(found.vec_id) == sorted(pd.read_parquet(f"{SF}/embeddings.parquet").vec_id)
