"""Resampling towards a target distribution (operator 12).

Words and runs of words are hashed into buckets. The array of the buckets'
gains, log ratios of their shares in a target table and in the corpus, scores
every document, and Gumbel noise from its id turns the score into a key whose
greatest values are a sample weighted by importance.

The sample's last key is found by distributed quickselect: keys drawn at random
as pivots, exact counts of the rows below, at and above each, and on in the part
that holds the k-th key. No more than the drawn rows are sorted.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import Scratch, append_columns, fresh, in_order, numbered, slices, utf8

BUCKETS = 10_000
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Keys drawn in a round of the selection, and words whose buckets a task remembers.
PIVOTS = 31
KNOWN_WORDS = 1 << 18
# The composite key, ascending: the score downwards, then the id with NULL last, then the row.
KEY = ("down", "unnamed", "doc_id", "row")


def feature_buckets(buckets: int, longest: int) -> Callable[[str | None], tuple[int, np.ndarray]]:
    """A function from a text to the number of its words and the buckets of its features."""
    known: dict[bytes, int] = {}

    def bucket(feature: bytes) -> int:
        found = known.get(feature)
        if found is None:
            found = zlib.crc32(feature) % buckets
            if len(known) >= KNOWN_WORDS:
                known.clear()
            known[feature] = found
        return found

    def features(text: str | None) -> tuple[int, np.ndarray]:
        words = WORD.findall(utf8(text).lower())
        runs = [
            bucket(b" ".join(words[i : i + size]) if size > 1 else words[i])
            for size in range(1, longest + 1)
            for i in range(len(words) - size + 1)
        ]
        return len(words), np.array(runs, np.int64)

    return features


def bucket_counts(docs: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = feature_buckets(buckets, longest), np.zeros(buckets, np.int64)
        for part in slices(batches):
            found = [features(text)[1] for text in part.column(0).to_pylist()]
            total += np.bincount(np.concatenate(found), minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled), pa.array(total[filled])], names=["bucket", "n"]
        )

    parts = docs.select("text").mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of the smoothed share in the target over that in the corpus)."""
    size = len(corpus)
    upper = (target + 1) * float(int(corpus.sum()) + size)
    lower = (corpus + 1) * float(int(target.sum()) + size)
    return np.floor(1000 * np.log(upper / lower)).astype(np.int64)


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise, in thousandths, of the id; a NULL id has the noise of no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _key(values: list | None = None) -> Column:
    """The order of the sample as one comparable value, of the rows or of a given key."""
    if values is None:
        return F.struct(*KEY)
    return F.struct(*[F.lit(v).alias(n) for v, n in zip(values, KEY, strict=True)])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS) -> list:
    """The k-th key (from 1) of a saved table with the columns of `_key`, all keys distinct."""
    low, high, turn = None, None, 0
    while True:
        inside = keys
        if low is not None:
            inside = inside.where(_key() > _key(low))
        if high is not None:
            inside = inside.where(_key() < _key(high))
        drawn = inside.orderBy(F.xxhash64("row", F.lit(turn))).limit(pivots)
        drawn = sorted(list(r.key) for r in drawn.select(_key().alias("key")).collect())
        above = sum(((_key() > _key(p)).cast("int") for p in drawn), F.lit(0))
        at = sum(((_key() == _key(p)).cast("int") for p in drawn), F.lit(0))
        parts = inside.groupBy(above.alias("above"), at.alias("at")).count().collect()
        counts = {(r.above, r.at): r["count"] for r in parts}
        for place in range(len(drawn) + 1):
            below = counts.get((place, 0), 0)
            if k <= below:
                low = drawn[place - 1] if place else low
                high = drawn[place] if place < len(drawn) else high
                break
            k -= below
            same = counts.get((place, 1), 0)
            if k <= same:
                return drawn[place]
            k -= same
        turn += 1


def scored(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = 1, seed: int = 2024
) -> DataFrame:
    """`docs` with n_words, n_features, weight and score (long), under free names if taken."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))

    def factory():
        features = feature_buckets(buckets, longest)

        def score(texts):
            words, sizes, weights = [], [], []
            for text in texts:
                n, places = features(text)
                words.append(n)
                sizes.append(len(places))
                weights.append(int(gain[places].sum()) // len(places) if len(places) else 0)
            return words, sizes, weights

        return score

    names = [fresh(docs, n) for n in ("n_words", "n_features", "weight")]
    fields = [T.StructField(n, T.LongType()) for n in names]
    found = append_columns(docs, ["text"], fields, factory)
    score = F.col(names[2]) + _noise(F.col("doc_id"), seed)
    return found.withColumn(fresh(docs, "score"), score)


def ranked(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    buckets: int = BUCKETS,
    longest: int = 1,
    seed: int = 2024,
    pivots: int = PIVOTS,
    label: str = "importance",
) -> DataFrame:
    """(row, doc_id, n_features, weight, score, rank) of every row of `docs` (row, doc_id, text).

    `row` is a number of its own per row; `target` has text. Of the documents
    with at least `least_words` words, floor(percent / 100) of their number are
    drawn, the greatest scores; equal scores go to the smaller doc_id, NULL
    last, equal ids to the smaller row. rank is the place in that order, NULL
    for what is not drawn. A NULL text has no words and weight 0; an empty
    target makes all gains follow from the corpus alone, and an empty table
    gives no rows.
    """
    scratch = Scratch(docs.sparkSession, label)
    found = scored(docs.select("row", "doc_id", "text"), target, buckets, longest, seed)
    enough = (F.col("n_words") >= least_words).alias("enough")
    found = scratch.save(found.select("row", "doc_id", "n_features", "weight", "score", enough))
    # NULL ids take the place of 0 in a key that sorts them last.
    parts = [-F.col("score"), F.isnull("doc_id"), F.coalesce("doc_id", F.lit(0)), F.col("row")]
    own = F.struct(*[c.alias(n) for c, n in zip(parts, KEY, strict=True)])
    size = found.where("enough").count() * percent // 100
    unranked = F.lit(None).cast("long").alias("rank")
    columns = ["row", "doc_id", "n_features", "weight", "score"]
    if not size:
        return found.select(*columns, unranked)
    last = kth_key(found.where("enough").select(own.alias("key")).select("key.*"), size, pivots)
    wins = F.col("enough") & (own <= _key(last))
    winners = in_order(
        found.where(wins), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "rank", scratch
    )
    rank = (F.col("rank") + 1).alias("rank")
    return winners.select(*columns, rank).unionByName(
        found.where(~wins).select(*columns, unranked)
    )


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of `docs`, all their columns, in no particular order."""
    row = fresh(docs, "row")
    rows = numbered(docs, row)
    placed = ranked(rows.select(F.col(row).alias("row"), "doc_id", "text"), target, **settings)
    winners = placed.where("rank is not null").select(F.col("row").alias(row))
    return rows.join(winners, row, "left_semi").select(*docs.columns)
