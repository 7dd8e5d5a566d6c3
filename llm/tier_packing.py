"""Hierarchical packing of documents into windows of several lengths (operator 3).

A document's tokens are cut into full windows of the longest length; what is
left of it is routed to the shortest window length (tier) that holds it. A
window of a tier starts with a remainder of that tier, its gap is filled with
the longest remainders of shorter tiers that fit, and a last one is cut so that
the window is exactly full. Windows are thus powers of two without padding, but
for one per task. Each sequence goes to the step group with the fewest
tokens so far, so that the groups of a step differ by a window at most per task.

Each task packs the documents that it reads: no shuffle, and a bounded pool of
remainders in memory.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapreplace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from llm.common import slices

VOCABULARY = "word_bpe_49k.json"
END = 2
TIERS = (512, 1024, 2048, 4096)
STEP_GROUPS = 64
# Remainders in a task's pool: it is packed down to the first number when it reaches the second.
POOL = (1024, 4096)
# Stems whose ids a worker remembers, and how many are encoded at once.
CACHE_WORDS = 300_000
TOGETHER = 200
# Texts whose words are looked up at once.
TEXTS = 4096
# ASCII punctuation but for the apostrophe, which begins words of its own.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# White space for str.split that the vocabulary's own rules take as text.
_NOT_SPACE = re.compile("[\x1c-\x1f]")


class WordIds:
    """Token ids of texts. White space separates tokens and has none, so words are encoded alone.

    A word is a stem and the ASCII punctuation behind it, which the vocabulary's
    rules always part, so that a stem is encoded once for all its endings. The
    stems met last are remembered in two halves: a full half takes the place of
    the other, whose stems are forgotten unless they were met again meanwhile.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters: dict[str, bool] = {}

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, from one text that holds them all."""
        found = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        starts = np.cumsum(lengths) - lengths
        at = np.array([o[0] for o in found.offsets], np.int64)
        edges = [*np.searchsorted(at, starts).tolist(), len(at)]
        raw = np.array(found.ids, "<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:], strict=False)]

    def _ids(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, remembered or encoded."""
        found = list(map(self.recent.get, parts))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        for i in gaps:
            found[i] = self.older.get(parts[i])
        new = [i for i in gaps if found[i] is None]
        for at in range(0, len(new), TOGETHER):
            block = new[at : at + TOGETHER]
            for i, ids in zip(block, self._together([parts[i] for i in block]), strict=True):
                found[i] = ids
        for i in gaps:
            if len(self.recent) >= CACHE_WORDS // 2:
                self.older, self.recent = self.recent, {}
            self.recent[parts[i]] = found[i]
        return found

    def _flat(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words behind each other, and how many each has."""
        stems, endings = self._split(words)
        coded = stems.dictionary_encode()
        kinds = list(dict.fromkeys(endings.values()))
        found = [b"", *self._ids(_strings(coded.dictionary) + kinds)]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        # Two parts of each word, the second one empty unless it has an ending.
        parts = np.zeros((len(words), 2), np.int64)
        parts[:, 0] = coded.indices.to_numpy() + 1
        number = {ending: len(coded.dictionary) + 1 + i for i, ending in enumerate(kinds)}
        parts[list(endings), 1] = [number[e] for e in endings.values()]
        ids = _runs(np.frombuffer(b"".join(found), "<u4"), lengths, parts.reshape(-1))
        return ids, lengths[parts].sum(axis=1)

    def __call__(self, texts: list[str | None], end: int = END) -> list[np.ndarray]:
        odd = [bool(_NOT_SPACE.search(t)) if t else False for t in texts]
        plain = pa.array(["" if o else t or "" for t, o in zip(texts, odd, strict=True)], pa.string())
        lists = pc.utf8_split_whitespace(plain)
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        flat, lengths = self._flat(coded.dictionary)
        ids = _runs(flat, lengths, index)
        edges = np.concatenate([[0], np.cumsum(lengths[index])])[lists.offsets.to_numpy()]
        tail = np.array([end], "<u4")
        out = []
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            own = np.frombuffer(self._alone(texts[i]), "<u4") if odd[i] else ids[a:b]
            out.append(np.concatenate([own, tail]))
        return out

    def _split(self, words: pa.Array) -> tuple[pa.Array, dict[int, str]]:
        """The stem of each word and, by its place, the ending of those that have one.

        A word is its own stem where the two are not sure to be parted.
        """
        stems = pc.utf8_rtrim(words, PUNCTUATION)
        last = pc.utf8_slice_codeunits(stems, -1).dictionary_encode()
        ends = pa.array([self._ends_a_token(c) for c in last.dictionary.to_pylist()], pa.bool_())
        parted = pc.and_not(ends.take(last.indices), pc.match_substring(words, "<|"))
        small = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems)
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy()
        at = np.flatnonzero((cut > 0) & parted.to_numpy(zero_copy_only=False))
        ended = _strings(words.take(pa.array(at)))
        endings = {i: w[-n:] for i, w, n in zip(at.tolist(), ended, cut[at].tolist(), strict=True)}
        return pc.if_else(parted, small, words), endings

    def _ends_a_token(self, letter: str) -> bool:
        """Whether the vocabulary's rules part punctuation from this character before it.

        They are asked: some letters they take apart into a letter and a mark,
        which goes with the punctuation, and not all know the same letters. No
        character before it, as in a word of punctuation alone: nothing to part.
        """
        if not letter:
            return False
        if letter not in self.letters:
            text = self.tokenizer.normalizer.normalize_str(f"{letter}!")
            parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            self.letters[letter] = letter.isalpha() and [p for p, _ in parts[1:]] == ["!"]
        return self.letters[letter]


def _strings(column: pa.Array) -> list[str]:
    """A column without NULL as a list, which Arrow makes at once only by way of an array of objects."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _runs(flat: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs that `flat` is made of, of these lengths, in the order of `index`."""
    sizes = lengths[index]
    begin = (np.cumsum(lengths) - lengths)[index]
    # Where each run begins in `flat`, stepped through id by id.
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(begin - before, sizes) + np.arange(int(sizes.sum()))]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Packs (doc_id, ids) one after another; `emitted` collects the pieces."""

    def __init__(self, first_sequence: int, tiers=TIERS, groups: int = STEP_GROUPS):
        self.tiers = tuple(sorted(tiers))
        self.sequence = first_sequence
        # Tokens and number of each group; tasks order equal ones differently.
        turn = (first_sequence >> 33) * 7919
        self.load = [(0, i, (i + turn) % groups) for i in range(groups)]
        self.pool: list[tuple] = []
        self.added = 0
        self.emitted: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        longest, total = self.tiers[-1], len(ids)
        whole = total - total % longest
        for start in range(0, whole, longest):
            self._close(longest, [(doc_id, total, start, ids[start : start + longest])])
        if whole < total:
            # A copy, so that the pool holds no long document for the sake of its end.
            self._return(doc_id, total, whole, ids[whole:].copy())
        if len(self.pool) >= POOL[1]:
            self._pack(POOL[0])

    def finish(self) -> None:
        self._pack(0)

    def _return(self, doc_id, total: int, start: int, rest: np.ndarray) -> None:
        self.added += 1
        insort(self.pool, (len(rest), self.added, doc_id, total, start, rest))

    def _pack(self, down_to: int) -> None:
        while len(self.pool) > down_to:
            left, _, *piece = self.pool.pop()
            tier = next(t for t in self.tiers if t >= left)
            pieces, gap = [piece], tier - left
            while gap and self.pool:
                at = bisect_right(self.pool, (gap, float("inf"))) - 1
                # The longest that fits, else the shortest, which is cut.
                left, _, doc_id, total, start, rest = self.pool.pop(max(at, 0))
                taken = min(left, gap)
                pieces.append((doc_id, total, start, rest[:taken]))
                gap -= taken
                if taken < left:
                    self._return(doc_id, total, start + taken, rest[taken:])
            self._close(self.tiers[-1] if gap else tier, pieces)

    def _close(self, window: int, pieces: list) -> None:
        tokens, order, group = self.load[0]
        heapreplace(self.load, (tokens + window, order, group))
        offset = 0
        for doc_id, total, start, ids in pieces:
            crc, length = zlib.crc32(ids.tobytes()), len(ids)
            self.emitted.append(
                (doc_id, start, length, crc, total, self.sequence, offset, window, group)
            )
            offset += length
        self.sequence += 1


PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "window int, step_group int"
)


def packed(docs: DataFrame, path: str | None = None, tiers=TIERS) -> DataFrame:
    """One row per piece of `docs` (doc_id, text): see PIECES.

    A document's ids are the vocabulary's for its text and then the end id; a
    NULL, empty or blank text has the end id alone. Sequences are `window` long,
    where only a task's last one is padded, to the longest length. A repeated
    row is a document of its own. An empty table gives no rows.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(PIECES).fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        packer = Packer(TaskContext.get().partitionId() << 33, tiers)
        kinds = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.emitted, strict=True)) or [()] * len(names)
            packer.emitted = []
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for part in slices(batches, TEXTS):
            kinds = kinds or [part.column(0).type, *[pa.int64()] * 6, pa.int32(), pa.int32()]
            texts = part.column(1).to_pylist()
            for doc_id, ids in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                packer.add(doc_id, ids)
            if len(packer.emitted) >= 10_000:
                yield flush()
        packer.finish()
        if packer.emitted:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
