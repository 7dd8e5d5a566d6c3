"""Language identification by hyperdimensional letter profiles (operator 2).

Every letter has a random vector of +1 and -1. Three letters in a row are bound
into one vector: the product of the first one's, rotated twice, the second
one's, rotated once, and the third one's. A text is the sum of its trigrams'
vectors, a language the sum of its texts, and the language whose prototype has
the greatest cosine with the text is the prediction. What is no letter counts as
one boundary between words.

Training is one pass: tasks count trigrams per language and bundle them once,
so what is gathered is a vector per task and language.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import append_columns, slices

DIMENSIONS = 1024
SEED = 2
UNKNOWN = "und"
# Distinct trigrams that a task counts before it bundles them.
HELD_TRIGRAMS = 1 << 18
BUNDLED = 4096
TOGETHER = 64


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Lower-case letter of every code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        if (char := chr(code)).isalpha():
            table[code] = ord(char.lower()[0])
    return table


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams (21 bits a letter) of a text and their counts; none without letters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = np.concatenate([[0], letter_table()[codes], [0]]).astype(np.uint64)
    if not letters.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keep = letters != 0
    keep[0] = True
    keep[1:] |= letters[:-1] != 0
    x = letters[keep]
    return np.unique(x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:], return_counts=True)


class Vectors:
    """Trigram vectors, from letter vectors that depend on seed and code point alone."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.row: dict[int, int] = {}
        self.rotated = [np.empty((0, dimensions), np.int8)] * 3

    def _rows(self, letters: np.ndarray) -> np.ndarray:
        distinct, inverse = np.unique(letters, return_inverse=True)
        new = [c for c in distinct.tolist() if c not in self.row]
        if new:
            drawn = [np.random.Generator(np.random.PCG64([self.seed, c])) for c in new]
            signs = [g.integers(0, 2, self.dimensions, np.int8) * 2 - 1 for g in drawn]
            for turns in range(3):
                more = np.roll(np.array(signs, np.int8), turns, axis=1)
                self.rotated[turns] = np.concatenate([self.rotated[turns], more])
            self.row |= {c: len(self.row) + i for i, c in enumerate(new)}
        return np.array([self.row[c] for c in distinct.tolist()])[inverse]

    def of(self, keys: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << 21) - 1)
        a = self._rows(keys >> np.uint64(42))
        b = self._rows(keys >> np.uint64(21) & mask)
        c = self._rows(keys & mask)
        return self.rotated[2][a] * self.rotated[1][b] * self.rotated[0][c]

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The exact sum of the trigrams' vectors."""
        total = np.zeros(self.dimensions, np.int64)
        for at in range(0, len(keys), BUNDLED):
            part = slice(at, at + BUNDLED)
            # Sums of products of whole numbers below 2**53 are exact in doubles.
            total += (counts[part].astype(float) @ self.of(keys[part]).astype(float)).astype(int)
        return total

    def texts(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """A row per text: the sum of its trigrams' vectors."""
        keys = np.unique(np.concatenate([k for k, _ in found]))
        out = np.zeros((len(found), self.dimensions), np.float32)
        counts = np.zeros((len(found), len(keys)), np.float32)
        for i, (k, n) in enumerate(found):
            counts[i, np.searchsorted(keys, k)] = n
        for at in range(0, len(keys), BUNDLED):
            part = slice(at, at + BUNDLED)
            out += counts[:, part] @ self.of(keys[part]).astype(np.float32)
        return out


def prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """A vector per language of `labelled` (text, lang); rows without either are left out.

    The driver gets one vector per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums, held = Vectors(), {}, {}

        def flush() -> None:
            for lang, parts in held.items():
                keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate([n for _, n in parts]), len(keys))
                sums[lang] = sums.get(lang, 0) + vectors.bundle(keys, counts)
            held.clear()

        size = 0
        for part in slices(batches):
            for text, lang in zip(*[c.to_pylist() for c in part.columns], strict=True):
                held.setdefault(lang, []).append(trigrams(text))
                size += len(held[lang][-1][0])
            if size > HELD_TRIGRAMS:
                flush()
                size = 0
        flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.int64()))],
            names=["lang", "vector"],
        )

    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    parts = usable.select("text", "lang").mapInArrow(run, "lang string, vector array<long>")
    sums = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col"))
    found: dict[str, np.ndarray] = {}
    for lang, at, value in sums.collect():
        found.setdefault(lang, np.zeros(DIMENSIONS))[at] = value
    return {lang: v for lang, v in found.items() if v.any()}


def effective(counts: np.ndarray) -> float:
    """How many trigrams a text has if repeats say little: the square of all over the sum of squares."""
    return float(counts.sum()) ** 2 / max(1.0, float((counts.astype(float) ** 2).sum()))


def with_language(docs: DataFrame, learned: dict[str, np.ndarray], columns: Sequence[str]) -> DataFrame:
    """`docs` with the predicted language and its score, 0 to 1, in two new columns.

    The score is the cosine with the prediction's prototype (0 if negative). Of
    equal cosines the least language wins. A NULL text, a text without letters,
    and any text if nothing was learned, is `und` with score 0. A third column,
    if named, has the text's effective number of trigrams, 0 without letters.
    """
    names = sorted(learned)
    matrix = np.array([learned[n] / np.linalg.norm(learned[n]) for n in names], np.float32)

    def factory():
        vectors = Vectors()

        def function(texts):
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            found = [trigrams(t or "") for t in texts] if names else []
            some = [i for i, (k, _) in enumerate(found) if len(k)]
            for at in range(0, len(some), TOGETHER):
                rows = some[at : at + TOGETHER]
                sums = vectors.texts([found[i] for i in rows])
                length = np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
                cosines = sums @ matrix.T / length
                for i, row in zip(rows, cosines, strict=True):
                    best = int(row.argmax())
                    langs[i], scores[i] = names[best], float(min(1.0, max(0.0, row[best])))
            sizes = [effective(n) for _, n in found] if names else [0.0] * len(texts)
            return (langs, scores, sizes)[: len(columns)]

        return function

    kinds = [T.StringType(), T.DoubleType(), T.DoubleType()]
    fields = [T.StructField(c, k) for c, k in zip(columns, kinds, strict=False)]
    return append_columns(docs, ["text"], fields, factory)
