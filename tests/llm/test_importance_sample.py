"""Importance resampling against a plain version and DuckDB; the selection against sorting."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm import importance_sample
from llm.common import numbered
from llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall((text or "").encode().lower())
    runs = range(1, longest + 1)
    return words, [b" ".join(words[i : i + n]) for n in runs for i in range(len(words) - n + 1)]


def plain(docs, target, percent, least_words, buckets, longest, seed):
    """(id, features, weight, score, rank) of (id, text) rows whose ids differ."""

    def counts(texts):
        return Counter(zlib.crc32(f) % buckets for t in texts for f in features(t, longest)[1])

    s, t = counts(text for _, text in docs), counts(target)
    big_s, big_t = s.total(), t.total()
    rows, order = {}, []
    for i, text in docs:
        words, found = features(text, longest)
        weight = 0
        for f in found:
            b = zlib.crc32(f) % buckets
            part = ((t[b] + 1) * (big_s + buckets)) / ((s[b] + 1) * (big_t + buckets))
            weight += math.floor(1000 * math.log(part))
        weight = weight // len(found) if found else 0
        name = "" if i is None else i
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[i] = [i, len(found), weight, score, None]
        if len(words) >= least_words:
            order.append((-score, i is None, i or 0, i))
    for rank, (*_, i) in enumerate(sorted(order)[: percent * len(order) // 100], 1):
        rows[i][4] = rank
    return {tuple(r) for r in rows.values()}


def test_query_equals_oracle(spark):
    name = "op12_importance_sample"
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == ""


@pytest.mark.parametrize("percent,longest,pivots", [(10, 1, 31), (60, 2, 3), (100, 3, 2)])
def test_equals_plain_version(spark, percent, longest, pivots):
    rng = random.Random(1)
    vocabulary = ["One", "two", "été", "Ñandú", "x1", "4", "don't", "the"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 12))) for _ in range(200)]
    docs = [*enumerate(texts), (None, "the two one"), (300, None), (301, ""), (302, "-- !! \0")]
    target = ["the two été été", None, "", "x1 the THE"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    df = df.withColumn("row", F.monotonically_increasing_id())
    found = importance_sample.ranked(
        df,
        spark.createDataFrame([(t,) for t in target], "text string"),
        **{"percent": percent, "least_words": 3, "buckets": 50, "longest": longest, "seed": 7},
        pivots=pivots,
    )
    got = {tuple(r) for r in found.drop("row").collect()}
    assert got == plain(docs, target, percent, 3, 50, longest, 7)


def test_selection_equals_sorting(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(20), rng.random() < 0.1, rng.randrange(5), i) for i in range(500)]
    keys = spark.createDataFrame(rows, "down long, unnamed boolean, doc_id long, row long")
    ordered = [list(r) for r in sorted(rows)]
    for k in (1, 77, 500):
        for pivots in (3, 31):
            assert importance_sample.kth_key(keys, k, pivots) == ordered[k - 1]


SCHEMA = "doc_id long, text string, row string, score double, rank int, weight string, key int"


def test_odd_rows(spark):
    long_text = "wörd " * 40000
    rows = [
        (None, None, None, None, None, None, None),
        (None, "a b c d", "r", 0.5, 1, "w", 1),
        (1, "a b c d", "r", 0.5, 1, "w", 1),
        (1, "a b c d", "r", 0.5, 1, "w", 1),
        (2, "", "r", None, 1, "w", 1),
        (3, long_text, "r", 0.5, None, None, 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = spark.createDataFrame([("a b",), (None,)], "text string")
    own = numbered(docs.select("doc_id", "text"), "row")
    found = importance_sample.ranked(own, target, percent=100, least_words=4).toPandas()
    assert len(found) == 6 and sorted(found["rank"].dropna()) == [1, 2, 3, 4]
    assert found[found.doc_id == 3].n_features.tolist() == [40000]
    assert (found[found.n_features == 0].weight == 0).all()
    # Repeated rows are drawn one by one: of the two equal ones one can stay behind.
    ranks = found[found.doc_id == 1]["rank"].sort_values().tolist()
    assert ranks[1] == ranks[0] + 1
    kept = importance_sample.drawn(docs, target, percent=50, least_words=4)
    assert kept.columns == docs.columns and kept.count() == 2
    again = importance_sample.drawn(docs, target, percent=50, least_words=4)
    assert sorted(map(str, kept.collect())) == sorted(map(str, again.collect()))
    with_score = importance_sample.scored(docs, target)
    assert with_score.columns[: len(docs.columns)] == docs.columns
    assert with_score.columns[-1] == "score_" and with_score.count() == 6
    empty = spark.createDataFrame([], SCHEMA)
    assert importance_sample.drawn(empty, target).count() == 0
    nothing = spark.createDataFrame([], "text string")
    assert importance_sample.ranked(own, nothing, percent=100, least_words=4).count() == 6
