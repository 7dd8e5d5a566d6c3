"""Toxicity by two class-conditional Kneser-Ney models (operator 7).

Texts are bytes: ASCII letters in lower case, runs of ASCII punctuation and
white space one blank. Both classes have an interpolated model over grams of
5 bytes. The orders from 3 to 5 have counts of their own class; what they
discount goes to continuation counts over both classes below, so that rare
expressions are smoothed alike and cancel. A text's score is the difference of
its two log-likelihoods over its length plus a constant, brought to 0 to 1 by a
logistic curve fitted on labelled texts that the models have not seen.

Fitted on at most `per_class` labelled documents of each class, those with the
smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import append_columns, in_fold, slices, utf8
from llm.grams import GramCounter, lookup, packed, suffix

ORDER = 5
LOWEST_OWN = 3
DISCOUNT = 0.75
# Bytes added to a text's length, so that a few of them decide little.
STEADY = 400
PER_CLASS = 4000
THRESHOLD = 0.3
FOLDS = (0, 1, 3)
# White space and punctuation become blanks, capitals small letters.
FOLDED = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256)
)


def text_grams(text: str | None) -> np.ndarray:
    folded = b" ".join(utf8(text).translate(FOLDED).split())
    if not folded:
        return np.empty(0, np.uint64)
    padded = b" " * (ORDER - 1) + folded + b" "
    return packed(np.frombuffer(padded, np.uint8), ORDER)


class Models:
    """Log ratio of both classes' probabilities, per gram and per history."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """`keys` sorted; `counts` has a column per class, ordinary and toxic."""
        self.keys = keys
        grams = {ORDER: keys}
        for order in range(ORDER - 1, 0, -1):
            grams[order] = np.unique(suffix(grams[order + 1], order))
        shared = self._shared(grams)
        own = [self._own(grams, counts[:, c], shared) for c in (0, 1)]
        # A gram without counts has the discounted mass of its history in both classes.
        self.ratios = np.log(own[1][0] / own[0][0]).astype(np.float32)
        self.histories = np.unique(keys >> np.uint64(8))
        self.history_ratios = np.log(own[1][1] / own[0][1]).astype(np.float32)

    @staticmethod
    def _shared(grams: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Kneser-Ney probabilities of grams below the own orders, from both classes together."""
        found: dict[int, np.ndarray] = {}
        for order in range(1, LOWEST_OWN):
            keys = grams[order]
            if not len(keys):
                found[order] = np.empty(0)
                continue
            up = np.searchsorted(keys, suffix(grams[order + 1], order))
            before = np.bincount(up, minlength=len(keys)).astype(float)
            history = np.unique(keys >> np.uint64(8), return_inverse=True)[1]
            total, kinds = np.bincount(history, before), np.bincount(history)
            lower = np.full(len(keys), 1 / 256)
            if order > 1:
                lower = found[order - 1][np.searchsorted(grams[order - 1], suffix(keys, order - 1))]
            held = np.maximum(before - DISCOUNT, 0) + DISCOUNT * kinds[history] * lower
            found[order] = held / total[history]
        return found

    @staticmethod
    def _own(
        grams: dict[int, np.ndarray], counts: np.ndarray, shared: dict[int, np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """A class's probability of each gram, and its backoff weight of each history."""
        below, weight = shared[LOWEST_OWN - 1], np.empty(0)
        for order in range(LOWEST_OWN, ORDER + 1):
            keys = grams[order]
            at = np.searchsorted(keys, suffix(grams[ORDER], order))
            own = np.bincount(at, counts, len(keys))
            history = np.unique(keys >> np.uint64(8), return_inverse=True)[1]
            total, kinds = np.bincount(history, own), np.bincount(history, own > 0)
            weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            lower = below[np.searchsorted(grams[order - 1], suffix(keys, order - 1))]
            seen = np.maximum(own - DISCOUNT, 0) / np.maximum(total, 1)[history]
            below = seen + weight[history] * lower
        return below, weight

    def difference(self, text: str | None) -> float:
        """Length-normalised toxic minus ordinary log-likelihood."""
        grams = text_grams(text)
        if not len(grams) or not len(self.keys):
            return 0.0
        at, known = lookup(self.keys, grams)
        total = float(self.ratios[at[known]].sum(dtype=float))
        at, known = lookup(self.histories, grams[~known] >> np.uint64(8))
        total += float(self.history_ratios[at[known]].sum(dtype=float))
        return total / (len(grams) + STEADY)


def logistic(
    values: np.ndarray, toxic: np.ndarray, times: np.ndarray, rounds: int = 50
) -> tuple[float, float]:
    """Slope and offset of P(toxic | value), by Newton steps on a lightly penalised likelihood."""
    if not len(values):
        return 0.0, 0.0
    scale = max(float(np.std(values)), 1e-9)
    x = np.stack([values / scale, np.ones(len(values))], axis=1)
    theta, penalty = np.zeros(2), np.diag([1e-2, 1e-4])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (times * (p - toxic)) + penalty @ theta
        curve = (x * (times * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        theta = theta - step * min(1.0, 3.0 / max(1e-9, float(np.abs(step).max())))
    return float(theta[0] / scale), float(theta[1])


def _drawn(rows: DataFrame, per_class: int) -> DataFrame:
    """At most `per_class` rows (doc_id, toxic) of each class, by a hash of the id."""
    order = [F.xxhash64("doc_id"), "doc_id"]
    parts = [rows.where(F.col("toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    return parts[0].union(parts[1])


def fitted(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS
) -> tuple[Models, tuple[float, float]]:
    """Models and logistic curve from labelled documents whose fold is not 2.

    The fold is crc32 of doc_id modulo 4. The curve is fitted on values that
    each fold gets from models of the other folds; the models returned have
    learned from all of them. Labels other than 0 and 1 and rows without text
    are left out; a document with several labels counts for each.
    """
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.where(~in_fold("doc_id", 4, 2))
    fold = (F.crc32(F.col("doc_id").cast("string")) % 4).cast("int").alias("fold")
    # Drawn rows are bounded by `per_class`, so they can go to every task.
    drawn = F.broadcast(_drawn(rows, per_class).select("doc_id", "toxic", fold))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    texts = texts.join(drawn, "doc_id").select("text", "toxic", "fold")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {(c, f): GramCounter() for c in (0, 1) for f in FOLDS}
        for part in slices(batches):
            for text, *kind in zip(*[c.to_pylist() for c in part.columns], strict=True):
                counters[tuple(kind)].add(text_grams(text))
        for (toxic, number), counter in counters.items():
            keys, counts = counter.result()
            both = [pa.array([x] * len(keys), pa.int32()) for x in (toxic, number)]
            columns = [*both, pa.array(keys.view(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "fold", "gram", "n"])

    kinds = [(c, f) for c in (0, 1) for f in FOLDS]
    of = lambda c, f: (F.col("toxic") == c) & (F.col("fold") == f)
    sums = [F.sum(F.when(of(c, f), F.col("n")).otherwise(0)).alias(f"n{c}{f}") for c, f in kinds]
    grams = texts.mapInArrow(count, "toxic int, fold int, gram long, n long").groupBy("gram")
    found = grams.agg(*sums).toPandas().sort_values("gram")
    keys = found["gram"].to_numpy().view(np.uint64)
    counts = {kind: found[f"n{kind[0]}{kind[1]}"].to_numpy(float) for kind in kinds}

    def models(folds: list[int]) -> Models:
        used = np.stack([sum(counts[c, f] for f in folds) for c in (0, 1)], axis=1)
        some = used.any(axis=1)
        return Models(keys[some], used[some])

    without = {f: models([g for g in FOLDS if g != f]) for f in FOLDS}
    shared = docs.sparkSession.sparkContext.broadcast(without)

    def compare():
        return lambda texts, folds: [
            [shared.value[f].difference(t) for t, f in zip(texts, folds, strict=True)]
        ]

    field = T.StructField("value", T.DoubleType())
    checked = append_columns(texts, ["text", "fold"], [field], compare)
    checked = checked.select("value", "toxic").toPandas()
    n = rows.groupBy("toxic").count().toPandas().set_index("toxic")["count"]
    value, toxic = checked["value"].to_numpy(float), checked["toxic"].to_numpy(int)
    # The classes' own numbers decide the curve, not those of the draw.
    times = [n.get(c, 0) / max(1, int((toxic == c).sum())) for c in (0, 1)]
    curve = logistic(value, toxic, np.where(toxic == 1, times[1], times[0]))
    return models(list(FOLDS)), curve


def with_difference(docs: DataFrame, models: Models, column: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def factory():
        return lambda texts: [[shared.value.difference(t) for t in texts]]

    return append_columns(docs, ["text"], [T.StructField(column, T.DoubleType())], factory)


def with_score(docs: DataFrame, fit: tuple, column: str) -> DataFrame:
    """`docs` with the probability of being toxic in a new column.

    NULL, empty and blank texts have the probability of a text that no class
    favours. Without labelled documents every text has 0.5 of nothing: 0.
    """
    models, (slope, offset) = fit
    scored = with_difference(docs, models, column)
    if not len(models.keys):
        return scored.withColumn(column, F.lit(0.0))
    return scored.withColumn(column, 1 / (1 + F.exp(-(F.col(column) * slope + offset))))
