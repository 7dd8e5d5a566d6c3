"""Token counts by a compiled byte-pair transducer (operator 5).

The vocabulary's merges are compiled into a deterministic transducer over
bytes. After a prefix of a word, the last token of the prefix's encoding is the
one token, among those that end there, which forms a valid pair with the last
token of the prefix that it continues. So a state need only hold the starts at
which a token may still be open: the bytes since, the last token before, and
how many tokens less than now there were. Transitions carry the change of the
count; states and transitions are built when a text first needs them.

A chunk of text acts on what surrounds it by a state map: the text before its
first safe boundary, the tokens between its first and last one, and the text
after the last. Maps of neighbouring chunks compose, associatively, so a long
text is counted chunk by chunk in parallel and its maps are joined in a
balanced scan. Safe boundaries lie between a visible character and white space:
no token crosses them.
"""

from __future__ import annotations

import json
from functools import lru_cache

import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import append_columns, numbered, utf8

VOCABULARY = "byte_bpe_50k.json"
CHUNK_CHARS = 1 << 18
# Segments that a worker remembers, and the longest one remembered.
CACHE_SEGMENTS = 500_000
CACHE_LENGTH = 48
SPACE = r"\p{White_Space}"
SEGMENTS = regex.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
BOUNDARY = regex.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])")
LAST_BOUNDARY = regex.compile(rf"(?r)(?<=[^{SPACE}])(?=[{SPACE}])")
# Characters (hexadecimal) that newer tables class as letters or numbers, and this
# package's expressions with them, but the vocabulary's library as neither.
NEITHER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 "
    "1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 16FF4-16FF6 "
    "187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 "
    "1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD "
    "323B0-33479 3D000-3FC3F "
)


def _words(letter: str, number: str, other: str) -> regex.Pattern:
    """Fixed: how the vocabulary's files split text into words."""
    return regex.compile(
        rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


def _classed_apart() -> str:
    ends = [r.split("-") for r in NEITHER.split()]
    return "".join(f"\\U{int(e[0], 16):08x}-\\U{int(e[-1], 16):08x}" for e in ends)


WORDS = _words(r"\p{L}", r"\p{N}", rf"[^{SPACE}\p{{L}}\p{{N}}]")
# The same for texts with such characters, which is slower.
APART = regex.compile(f"[{_classed_apart()}]")
WORDS_APART = _words(
    rf"[\p{{L}}--[{_classed_apart()}]]",
    rf"[\p{{N}}--[{_classed_apart()}]]",
    rf"[[^{SPACE}\p{{L}}\p{{N}}]||[{_classed_apart()}]]",
)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """Counts the tokens of a word; `merges` are pairs of byte strings, the strongest first."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in merges}
        self.openings = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.valid: dict[tuple[bytes | None, bytes], bool] = {}
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[int, tuple[int, int]]] = []
        self.start = self._state(((b"", None, 0),))

    def merged(self, piece: bytes) -> list[bytes]:
        """The encoding of a short piece, merge by merge; only pairs of tokens are merged so."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            pairs = zip(parts, parts[1:], strict=False)
            best, at = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(pairs))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _is_valid(self, before: bytes | None, token: bytes) -> bool:
        key = (before, token)
        if key not in self.valid:
            wanted = [token] if before is None else [before, token]
            self.valid[key] = self.merged(b"".join(wanted)) == wanted
        return self.valid[key]

    def _state(self, opened: tuple) -> int:
        if opened not in self.numbers:
            self.numbers[opened] = len(self.states)
            self.states.append(opened)
            self.steps.append({})
        return self.numbers[opened]

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        letter = bytes([byte])
        grown = [(s + letter, before, d) for s, before, d in self.states[state]]
        token, count = next(
            (s, d + 1) for s, before, d in grown if s in self.tokens and self._is_valid(before, s)
        )
        opened = tuple((s, before, d - count) for s, before, d in grown if s in self.openings)
        step = (self._state((*opened, (b"", token, 0))), count)
        self.steps[state][byte] = step
        return step

    def count(self, word: bytes) -> int:
        state, total, steps = self.start, 0, self.steps
        for byte in word:
            state, change = steps[state].get(byte) or self._step(state, byte)
            total += change
        return total


class Counter:
    """Counts the tokens of texts with a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.transducer = Transducer([(as_bytes(a), as_bytes(b)) for a, b in pairs])
        special = [regex.escape(t["content"]) for t in content["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.known: dict[str, int] = {}

    def _segment(self, segment: str) -> int:
        total, parts = 0, [segment]
        if self.special is not None:
            parts = self.special.split(segment)
            total = len(parts) - 1
        for part in parts:
            words = WORDS if part.isascii() or not APART.search(part) else WORDS_APART
            for word in words.findall(part):
                total += self.transducer.count(utf8(word))
        return total

    def count(self, text: str) -> int:
        total, known = 0, self.known
        for segment in SEGMENTS.findall(text):
            found = known.get(segment)
            if found is None:
                found = self._segment(segment)
                if len(segment) <= CACHE_LENGTH:
                    if len(known) >= CACHE_SEGMENTS:
                        known.clear()
                    known[segment] = found
            total += found
        return total

    def state_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(head, tokens, tail); tail is None if the chunk holds no safe boundary."""
        first = BOUNDARY.search(chunk)
        if first is None:
            return chunk, 0, None
        cut = LAST_BOUNDARY.search(chunk).start()
        return chunk[: first.start()], self.count(chunk[first.start() : cut]), chunk[cut:]

    def composed(self, left: tuple, right: tuple) -> tuple[str, int, str | None]:
        """The state map of two neighbouring chunks."""
        if left[2] is None and right[2] is None:
            return self.state_map(left[0] + right[0])
        if left[2] is None:
            # Two texts without a boundary may have one where they meet.
            head, more, tail = self.state_map(left[0] + right[0])
            if tail is None:
                return head, right[1], right[2]
            return head, more + self.count(tail) + right[1], right[2]
        middle = left[2] + right[0]
        if right[2] is None:
            head, more, tail = self.state_map(middle)
            if tail is None:
                return left[0], left[1], middle
            return left[0], left[1] + self.count(head) + more, tail
        return left[0], left[1] + self.count(middle) + right[1], right[2]

    def total(self, maps: list[tuple]) -> int:
        """Tokens of a text from the maps of its chunks, joined pairwise level by level."""
        while len(maps) > 1:
            pairs = zip(maps[::2], maps[1::2], strict=False)
            odd = maps[-1:] if len(maps) % 2 else []
            maps = [self.composed(a, b) for a, b in pairs] + odd
        head, middle, tail = maps[0]
        return self.count(head) + middle + (0 if tail is None else self.count(tail))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def counted(docs: DataFrame, path: str | None = None, chunk: int = CHUNK_CHARS) -> DataFrame:
    """(row, doc_id, n_bytes, n_tokens) of every row of `docs` (doc_id, text).

    A NULL or empty text has no bytes and no tokens. Repeated rows are counted
    each. The added tokens of the vocabulary count one where a text spells them.
    An empty table gives no rows.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    text = F.coalesce("text", F.lit(""))
    numbers = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / chunk).cast("int"))
    numbers = F.when(F.length(text) > chunk, numbers).otherwise(F.array(F.lit(0)))
    rows = numbered(docs.select("doc_id", text.alias("text")), "row")
    chunks = rows.select("row", "doc_id", "text", F.explode(numbers).alias("at"))
    piece = F.when(F.length("text") <= chunk, F.col("text")).otherwise(
        F.substring("text", F.col("at") * chunk + 1, F.lit(chunk))
    )
    chunks = chunks.select("row", "doc_id", "at", piece.alias("piece"))

    def maps():
        count = counter(path)

        def function(pieces):
            found = [count.state_map(p) for p in pieces]
            heads, middles, tails = zip(*found, strict=True)
            return [len(utf8(p)) for p in pieces], heads, middles, tails

        return function

    fields = T.StructType.fromDDL("n_bytes long, head string, middle long, tail string").fields
    mapped = append_columns(chunks, ["piece"], fields, maps).drop("piece")
    grouped = mapped.groupBy("row", "doc_id").agg(
        F.sum("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("at", "head", "middle", "tail"))).alias("maps"),
    )

    def totals():
        count = counter(path)

        def function(lists):
            every = [[(m["head"], m["middle"], m["tail"]) for m in maps] for maps in lists]
            return [[count.total(m) for m in every]]

        return function

    field = T.StructField("n_tokens", T.LongType())
    return append_columns(grouped, ["maps"], [field], totals).drop("maps")
