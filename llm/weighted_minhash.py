"""Document fingerprints by consistent weighted sampling (operator 9).

A document is the set of its words with their counts as weights. For every
sample number, gamma-based random numbers of the term give each term an
exponential race that is consistent over weights; the winner and its quantised
weight are the sample. Two documents agree in a sample with probability equal
to the generalised Jaccard similarity of their weights: the sum of the smaller
over the sum of the larger ones.

A term is the 64-bit hash of its word. Its random numbers are derived from that
hash and the sample number, so that they need no table; a table of bounded size
keeps those of the words met last, among them the frequent ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import slices, utf8

SAMPLES = 128
SEED = 9
# Terms whose random numbers a worker keeps at most; those of others are derived each time.
KEPT = 1 << 16
# Documents per range of ids, and ranges at most.
RANGE_ROWS = 256
MOST_RANGES = 4096
# Texts looked up at once that have a term, for it to be kept; a text and its edited text are two.
WORTH_KEEPING = 4
# Terms of a long text whose races run at once, and whose random numbers are derived at once.
BLOCK = 1 << 15
DERIVED = 128
# Characters of the texts whose words are looked up at once.
TOGETHER = 1 << 18


def _scrambled(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _gamma(halves: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) from pairs of 32 bits, of which the upper 23 count: -log of two uniform numbers' product."""
    uniform = (halves >> np.uint32(9)).view(np.int32).astype(np.float32)
    uniform += np.float32(0.5)
    uniform *= np.float32(1 / (1 << 23))
    return -np.log(uniform[:, ::2] * uniform[:, 1::2])


class Kept:
    """Rows of numbers per term, derived where they are not kept.

    The last `size` terms that are worth keeping are kept.
    """

    def __init__(self, size: int, width: int):
        self.size, self.next = size, 0
        self.slots: dict[int, int] = {}
        self.owner: list[int | None] = [None] * size
        self.table = np.empty((size, width), np.float32)

    def rows(
        self, terms: np.ndarray, derive: Callable[[np.ndarray], np.ndarray], worth: np.ndarray
    ) -> np.ndarray:
        get, names = self.slots.get, terms.tolist()
        places = np.array([get(t, -1) for t in names], np.int64)
        found = self.table[places] if self.size else np.empty((len(terms), self.table.shape[1]), np.float32)
        new = np.flatnonzero(places < 0)
        for at in range(0, len(new), DERIVED):
            found[new[at : at + DERIVED]] = derive(terms[new[at : at + DERIVED]])
        stay = new[worth[new]]
        stay = stay[max(0, len(stay) - self.size) :]
        slots = (self.next + np.arange(len(stay))) % max(1, self.size)
        self.next += len(stay)
        self.table[slots] = found[stay]
        for slot, at in zip(slots.tolist(), stay.tolist(), strict=True):
            self.slots.pop(self.owner[slot], None)
            self.owner[slot], self.slots[names[at]] = names[at], slot
        return found


class Races:
    """Random numbers of every term and sample: r and c from Gamma(2, 1), b uniform.

    What is kept changes no result: kept or derived, they are the same, and of
    equal races the term of the lesser hash wins.
    """

    def __init__(self, samples: int, seed: int, kept: int = KEPT):
        self.samples = samples
        # Two numbers of 64 bits per term and sample.
        steps = np.arange(1, 2 * samples + 1, dtype=np.uint64) + (np.uint64(seed) << np.uint64(32))
        self.steps = _scrambled(steps).reshape(2, samples)
        self.columns = np.arange(samples)
        # Most words occur once in a text: their races need one number a sample, the others' three.
        self.once, self.often = Kept(kept, samples), Kept(kept // 4, 3 * samples)

    def derived(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, log c and b: a row per term."""
        x, y = (_scrambled(terms[:, None] + steps).view(np.uint32) for steps in self.steps)
        # b is made of the bits that r leaves over.
        low = x & np.uint32(511)
        b = (low[:, ::2] << np.uint32(9) | low[:, 1::2]).view(np.int32).astype(np.float32)
        b *= np.float32(1 / (1 << 18))
        return _gamma(x), np.log(_gamma(y)), b

    def _once(self, terms: np.ndarray) -> np.ndarray:
        """The race of weight 1, whose logarithm is 0."""
        r, log_c, b = self.derived(terms)
        return log_c - r * (1 - b)

    def _often(self, terms: np.ndarray) -> np.ndarray:
        return np.concatenate(self.derived(terms), axis=1)

    def signatures(self, texts: list[str]) -> list[bytes | None]:
        """The signature's bytes of each text; None for one without words."""
        found, group, size = [], [], 0
        for text in texts:
            if group and size + len(text) > TOGETHER:
                found += self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return found + (self._group(group) if group else [])

    def _group(self, texts: list[str]) -> list[bytes | None]:
        lists = pc.ascii_split_whitespace(pa.array(map(utf8, texts), pa.binary()).cast(pa.string()))
        words = lists.flatten()
        owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        there = pc.greater(pc.binary_length(words), 0)
        owner, coded = owner[there.to_numpy(zero_copy_only=False)], words.filter(there).dictionary_encode()
        names = coded.dictionary.to_pylist()
        terms = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
        # In the order of their hashes, so that the first of equal races is the one that wins.
        order = np.argsort(terms)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        terms = terms[order]
        pairs, weights = np.unique(
            owner * max(1, len(terms)) + rank[coded.indices.to_numpy()], return_counts=True
        )
        text, term = np.divmod(pairs, max(1, len(terms)))
        edges = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
        if len(terms) > BLOCK and len(texts) == 1:
            return [self.signature(terms, weights)]
        worth = np.bincount(term, minlength=len(terms)) >= WORTH_KEEPING
        once = self.once.rows(terms, self._once, worth)
        heavy = np.unique(term[weights > 1])
        often = self.often.rows(terms[heavy], self._often, worth[heavy])
        found = []
        for start, end in zip(edges, edges[1:], strict=False):
            own, counts = term[start:end], weights[start:end]
            light, more = own[counts == 1], own[counts > 1]
            state = self._start()
            if len(light):
                state = self._better(state, once[light], None, terms[light])
            if len(more):
                rows = often[np.searchsorted(heavy, more)]
                state = self._better(state, *self._raced(rows, counts[counts > 1]), terms[more])
            found.append(self._value(state) if len(own) else None)
        return found

    def signature(self, terms: np.ndarray, weights: np.ndarray) -> bytes:
        """The signature of any number of terms: distinct hashes (uint64) in ascending order."""
        state = self._start()
        for at in range(0, len(terms), BLOCK):
            some, counts = terms[at : at + BLOCK], weights[at : at + BLOCK]
            light, more = some[counts == 1], some[counts > 1]
            if len(light):
                rows = self.once.rows(light, self._once, np.zeros(len(light), bool))
                state = self._better(state, rows, None, light)
            if len(more):
                rows = self.often.rows(more, self._often, np.ones(len(more), bool))
                state = self._better(state, *self._raced(rows, counts[counts > 1]), more)
        return self._value(state)

    def _start(self) -> tuple:
        best = np.full(self.samples, np.inf, np.float32)
        return best, np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.uint64)

    def _raced(self, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Races and levels of terms with their weights; `rows` holds r, log c and b."""
        r, log_c, b = (rows[:, i * self.samples : (i + 1) * self.samples] for i in range(3))
        level = np.floor(np.log(weights).astype(np.float32)[:, None] / r + b)
        return log_c - r * (level - b + 1), level

    def _better(self, state: tuple, race: np.ndarray, level: np.ndarray | None, terms: np.ndarray) -> tuple:
        """The winners so far after further terms, in ascending order of their hashes, have raced."""
        best, who, levels = state
        first = race.argmin(axis=0)
        found, name = race[first, self.columns], terms[first]
        won = (found < best) | ((found == best) & (name < who))
        reached = np.uint64(0) if level is None else level[first, self.columns].astype(np.uint64)
        return np.where(won, found, best), np.where(won, name, who), np.where(won, reached, levels)

    def _value(self, state: tuple) -> bytes:
        """One 16-bit value per sample."""
        _, who, levels = state
        value = who * np.uint64(1_000_003) + levels * np.uint64(8_191) + np.uint64(1)
        return (value * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(">u2").tobytes()

    def of_text(self, text: str) -> bytes | None:
        return self.signatures([text])[0]


@lru_cache(maxsize=1)
def races(samples: int, seed: int) -> Races:
    return Races(samples, seed)


def likeness(a: bytes | None, b: bytes | None) -> float:
    """Share of equal samples; two texts without words are alike, one is unlike any other."""
    if a is None or b is None:
        return float(a is b)
    return float(np.mean(np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")))


def edited(text: str, following: str) -> str:
    """`text` whose last third is replaced by as much of the beginning of `following`."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _ranges(docs: DataFrame) -> tuple[list, DataFrame]:
    """Cuts that part the ids into even ranges, and `docs` with `part`, descending in doc_id."""
    rows = docs.agg(F.count("*")).first()[0]
    n = max(1, min(MOST_RANGES, math.ceil(rows / RANGE_ROWS)))
    share = [i / n for i in range(1, n)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", share, 4 * n)).first()[0]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def below(ids: pd.Series) -> pd.Series:
        at = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), "left")
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, at))

    return docs.withColumn("part", below("doc_id"))


def in_order(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) as (part, ahead, doc_id, tie, text), each part whole in one task.

    Parts and their rows descend in doc_id; NULL ids come last, equal ids are
    ordered by a hash of the text. A row marked `ahead` is a copy of the first
    row of the following part, or after the last part of the first one.
    """
    tied = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    placed = _ranges(tied)
    first = F.min_by(F.struct("doc_id", "tie"), F.struct(F.isnull("doc_id"), -F.col("doc_id"), "tie"))
    found = placed.groupBy("part").agg(first.alias("f")).select("part", "f.doc_id", "f.tie")
    parts = sorted(tuple(r) for r in found.collect())
    heads = [(parts[i - 1][0], *parts[i][1:]) for i in range(len(parts))]
    heads = docs.sparkSession.createDataFrame(heads, "before int, head long, head_tie long")
    same = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("tie") == F.col("head_tie"))
    own = F.struct("part", F.lit(False).alias("ahead"))
    copy = F.struct(F.col("before").alias("part"), F.lit(True).alias("ahead"))
    both = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))
    rows = placed.join(F.broadcast(heads), same, "left")
    rows = rows.select(F.explode(both).alias("place"), "doc_id", "tie", "text")
    rows = rows.select("place.*", "doc_id", "tie", "text")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["part", "ahead", F.desc_nulls_last("doc_id"), "tie"]
    return rows.repartition(width, "part").sortWithinPartitions(*order)


FIELDS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprinted(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and FIELDS of every row of `docs` (doc_id: long, text).

    The next document has the next lower doc_id, after the last one it is the
    first; a single document is its own next one. NULL texts are empty. A text
    without words has a fingerprint of zeros, alike only to its like. Repeated
    rows are rows of their own, neighbours of each other. An empty table gives
    no rows.
    """
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(FIELDS).fields])
    empty = "0000" * samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        race = races(samples, SEED)
        # The row whose next one is still to come: its part, id, text and signature.
        waiting = None
        for batch in slices(batches):
            rows = [(r["part"], r["ahead"], r["doc_id"], r["text"] or "") for r in batch.to_pylist()]
            before = [waiting and (waiting[0], False, *waiting[1:3]), *rows[:-1]]
            # Each row that has its next one here, and its edited text.
            closed = [
                (b, c) for b, c in zip(before, rows, strict=True) if b and not b[1] and b[0] == c[0]
            ]
            changed = [edited(b[3], c[3]) for b, c in closed]
            # Texts and edited texts side by side, as they share their words.
            after = iter(changed)
            mixed, places = [], []
            for b, c in zip(before, rows, strict=True):
                if b and not b[1] and b[0] == c[0]:
                    mixed.append(next(after))
                places.append(len(mixed))
                mixed.append(c[3])
            found = race.signatures(mixed)
            own = [waiting[3] if waiting else None, *[found[p] for p in places]]
            out, number = [], 0
            for i, (b, c) in enumerate(zip(before, rows, strict=True)):
                if b and not b[1] and b[0] == c[0]:
                    other = found[places[i] - 1]
                    near = likeness(own[i], other), likeness(own[i], own[i + 1])
                    digest = hashlib.sha256(utf8(changed[number])).hexdigest()
                    prints = [x.hex() if x else empty for x in (own[i], other)]
                    out.append((b[2], len(b[3]), digest, *prints, *near))
                    number += 1
            if rows:
                part, ahead, doc_id, text = rows[-1]
                waiting = None if ahead else (part, doc_id, text, own[-1])
            yield _batch(out, schema)

    ordered = in_order(docs.select(F.col("doc_id").cast("long"), "text"))
    return ordered.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)
