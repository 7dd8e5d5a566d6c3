"""Language-model scores by context-tree weighting over bytes (operator 6).

A byte is eight binary decisions, each with the bytes before as context. A
node of the tree (a context of up to 4 bytes and the bits so far) estimates its
decision by Krichevsky-Trofimov from its own counts, and mixes that, by the
weights that context-tree weighting gives both explanations of the training
texts, with what its longer contexts say. A context that training never saw
passes on the estimate of the longest one it did see.

All that the tree depends on are the counts of byte 5-grams, gathered from the
whole training part and kept distributed. Subtrees below two bytes are built
by tasks of their own; the two levels above them are combined from one vector
per byte. The result is a table of code lengths: a row per context, a value
per byte. Scoring reads it in blocks of bounded size and adds up what the
blocks give.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import Scratch, append_columns, numbered, slices, utf8
from llm.grams import GramCounter, lookup, packed, suffix

DEPTH = 4
# Bytes that UTF-8 never has: before a text, and after it.
START, END = 0xFE, 0xFF
# Contexts whose code lengths a task holds at once.
BLOCK_ROWS = 1 << 18
# A word is looked up in the tasks if its share of training is at least 1 to this,
# so at most that many are; the others are joined.
FREQUENT = 1 << 19
HALF = math.log(0.5)


def text_grams(text: str | None) -> np.ndarray:
    raw = bytes([START] * DEPTH) + utf8(text).lower() + bytes([END])
    return packed(np.frombuffer(raw, np.uint8), DEPTH + 1)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series from 8 on."""
    shift = np.zeros_like(x)
    x = x.copy()
    for _ in range(8):
        small = x < 8
        shift -= np.where(small, np.log(np.where(small, x, 1.0)), 0.0)
        x += small
    inverse = 1 / x
    series = inverse / 12 - inverse**3 / 360 + inverse**5 / 1260
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series


def bit_counts(counts: np.ndarray) -> np.ndarray:
    """(contexts, 512) sums of byte counts below every node of the bits' tree; node 1 is its root."""
    tree = np.zeros((len(counts), 512))
    tree[:, 256:] = counts
    for node in (128, 64, 32, 16, 8, 4, 2, 1):
        both = tree[:, 2 * node : 4 * node].reshape(len(counts), node, 2)
        tree[:, node : 2 * node] = both.sum(axis=2)
    return tree


def estimates(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every decision: log probability of its counts, and the estimate of a 1 (both (n, 256))."""
    tree = bit_counts(counts)
    zeros, ones = tree[:, 0::2], tree[:, 1::2]
    block = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1)
    block -= 2 * 0.5 * math.log(math.pi)
    return block, (ones + 0.5) / (zeros + ones + 1)


def weighted(block: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of inner nodes, and the weight of their own estimate."""
    total = np.logaddexp(block, children) + HALF
    return total, np.exp(block + HALF - total)


def code_lengths(ones: np.ndarray) -> np.ndarray:
    """(contexts, 256) log10 probability of each byte from the probabilities of a 1."""
    tree = np.zeros((len(ones), 512))
    for node in (1, 2, 4, 8, 16, 32, 64, 128):
        own, p = tree[:, node : 2 * node], ones[:, node : 2 * node]
        pair = np.stack([own + np.log10(1 - p), own + np.log10(p)], axis=2)
        tree[:, 2 * node : 4 * node] = pair.reshape(len(ones), -1)
    return tree[:, 256:]


class Level:
    """All contexts of one length below some node, with what the tree needs of them."""

    def __init__(self, contexts: np.ndarray, counts: np.ndarray, below: Level | None, length: int):
        self.contexts, self.counts, self.length = contexts, counts, length
        self.block, self.ones = estimates(counts)
        if below is None:
            self.total, self.weight = self.block, None
        else:
            self.parent = np.searchsorted(contexts, suffix(below.contexts, length))
            children = sum_rows(below.total, self.parent, len(contexts))
            self.total, self.weight = weighted(self.block, children)


def sum_rows(rows: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows by group number; every group has a row."""
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(size))
    return np.add.reduceat(rows[order], starts, axis=0)


def subtree(keys: np.ndarray, n: np.ndarray) -> dict[int, Level]:
    """Levels 2 to DEPTH of the contexts of one pair of last bytes."""
    contexts, row = np.unique(keys >> np.uint64(8), return_inverse=True)
    counts = np.zeros((len(contexts), 256))
    np.add.at(counts, (row, (keys & np.uint64(255)).astype(np.int64)), n)
    levels = {DEPTH: Level(contexts, counts, None, DEPTH)}
    for length in range(DEPTH - 1, 1, -1):
        below = levels[length + 1]
        contexts = np.unique(suffix(below.contexts, length))
        parent = np.searchsorted(contexts, suffix(below.contexts, length))
        counts = sum_rows(below.counts, parent, len(contexts))
        levels[length] = Level(contexts, counts, below, length)
    return levels


def mixed(ones: np.ndarray, level_ones, weight, counts) -> np.ndarray:
    """One level up: its own estimate mixed with `ones`, where the longer context has counts."""
    tree = bit_counts(counts)
    seen = (tree[:, 0::2] + tree[:, 1::2]) > 0
    return np.where(seen, weight * level_ones + (1 - weight) * ones, level_ones)


class Top:
    """The tree's levels 0 and 1, from the sums that level 2 gives per last byte."""

    def __init__(self, last: np.ndarray, counts: np.ndarray, children: np.ndarray):
        self.last = last
        self.block, self.ones = estimates(counts)
        self.total, self.weight = weighted(self.block, children)
        self.counts = counts
        block, self.root_ones = estimates(counts.sum(axis=0, keepdims=True))
        _, self.root_weight = weighted(block, self.total.sum(axis=0, keepdims=True))

    def finished(self, at: int, ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probabilities of a 1 in contexts that end with byte number `at`, up to the root."""
        row = slice(at, at + 1)
        ones = mixed(ones, self.ones[row], self.weight[row], counts)
        return mixed(ones, self.root_ones, self.root_weight, self.counts[row])

    def rows(self) -> list[tuple[int, int, np.ndarray]]:
        """(length, context, log10 probabilities) of the contexts of length 0 and 1."""
        found = [(0, 0, code_lengths(self.root_ones)[0])]
        for at, byte in enumerate(self.last.tolist()):
            ones = mixed(self.ones[at : at + 1], self.root_ones, self.root_weight, self.counts[at : at + 1])
            found.append((1, byte, code_lengths(ones)[0]))
        return found


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams and counts of one pair of last bytes after another."""
    parts = [(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()) for b in batches]
    if not parts:
        return
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    pair = keys >> np.uint64(8) & np.uint64(0xFFFF)
    order = np.lexsort((keys, pair))
    keys, n, pair = keys[order], n[order], pair[order]
    for at in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(pair)) + 1):
        if len(at):
            yield keys[at], n[at]


def counted_grams(docs: DataFrame) -> DataFrame:
    """(gram, n) over all texts of `docs`; a task sends each distinct gram once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = GramCounter()
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                counter.add(text_grams(text))
        keys, counts = counter.result()
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(counts)], names=["gram", "n"]
        )

    sent = docs.select("text").mapInArrow(run, "gram long, n long")
    return sent.groupBy("gram").agg(F.sum("n").alias("n"))


class Tree:
    """The table of code lengths of a trained tree; `symbols` are the bytes it has values for."""

    def __init__(self, grams: DataFrame, scratch: Scratch):
        """`grams` is a saved table (gram, n); it is read three times."""
        seen = grams.select(F.col("gram").bitwiseAND(255).alias("b")).distinct().collect()
        self.symbols = np.array(sorted(r["b"] for r in seen), np.int64)
        pair = F.shiftright("gram", 8).bitwiseAND(0xFFFF)
        spread = grams.repartition(pair)
        top = self._top(spread)
        symbols = self.symbols

        def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for keys, n in _pairs(batches):
                levels = subtree(keys, n)
                at = int(np.searchsorted(top.last, int(keys[0] >> np.uint64(8)) & 0xFF))
                for length in range(2, DEPTH + 1):
                    yield _rows(levels, length, top, at, symbols)

        schema = "length int, context long, row binary"
        self.rows = scratch.save(spread.mapInArrow(lengths, schema)) if len(symbols) else None
        self.upper = top.rows() if len(symbols) else []
        count = self.rows.count() if len(symbols) else 0
        self.blocks = max(1, math.ceil(count / BLOCK_ROWS))

    def _top(self, spread: DataFrame) -> Top:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list] = {}
            for keys, n in _pairs(batches):
                level = subtree(keys, n)[2]
                last = int(keys[0] >> np.uint64(8)) & 0xFF
                held = found.setdefault(last, [np.zeros(256), np.zeros(256)])
                held[0] += level.counts[0]
                held[1] += level.total[0]
            columns = [list(found), *zip(*found.values(), strict=True)] if found else [[], [], []]
            kinds = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["last", "counts", "children"])

        # At most a row per task and last byte.
        sent = spread.mapInArrow(sums, "last int, counts array<double>, children array<double>")
        found: dict[int, list] = {}
        for row in sorted(sent.toLocalIterator(), key=lambda r: (r[0], r[1])):
            held = found.setdefault(row[0], [np.zeros(256), np.zeros(256)])
            held[0] += row[1]
            held[1] += row[2]
        last = np.array(sorted(found), np.int64)
        counts = np.array([found[b][0] for b in last.tolist()]).reshape(-1, 256)
        return Top(last, counts, np.array([found[b][1] for b in last.tolist()]).reshape(-1, 256))

    def block(self, number: int) -> Table:
        pair = F.col("context").bitwiseAND(0xFFFF)
        wanted = self.rows.where(pair % self.blocks == number).toArrow()
        upper = [(length, c, _compact(row[None], self.symbols)[0]) for length, c, row in self.upper]
        length = np.concatenate([wanted["length"].to_numpy(), [u[0] for u in upper]])
        context = np.concatenate([wanted["context"].to_numpy(), [u[1] for u in upper]])
        width = len(self.symbols) + 1
        low = np.frombuffer(b"".join(wanted["row"].to_pylist()), np.float32).reshape(-1, width)
        rows = np.concatenate([low, np.array([u[2] for u in upper], np.float32)])
        return Table(length, context, rows, self.symbols, (number, self.blocks))


def _compact(values: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Values of the trained bytes, then one for each other byte, which share what is left."""
    some = values[:, symbols]
    left = np.maximum(1 - (10.0**some).sum(axis=1), 1e-30) / max(1, 256 - len(symbols))
    return np.concatenate([some, np.log10(left)[:, None]], axis=1).astype(np.float32)


def _rows(levels: dict, length: int, top: Top, at: int, symbols: np.ndarray) -> pa.RecordBatch:
    """Code lengths of contexts of one length, as if longer ones had not been seen."""
    level = levels[length]
    ones, counts = level.ones, level.counts
    row = np.arange(len(level.contexts))
    for above in range(length - 1, 1, -1):
        upper = levels[above]
        row = np.searchsorted(upper.contexts, suffix(level.contexts, above))
        ones = mixed(ones, upper.ones[row], upper.weight[row], counts)
        counts = upper.counts[row]
    packed_rows = _compact(code_lengths(top.finished(at, ones, counts)), symbols)
    columns = [
        pa.array([length] * len(row), pa.int32()),
        pa.array(level.contexts.view(np.int64)),
        pa.array([r.tobytes() for r in packed_rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["length", "context", "row"])


class Table:
    """A block of the table, for lookups: the code lengths of the longest context that is there."""

    def __init__(self, length, context, rows, symbols, block: tuple[int, int]):
        self.rows, self.number, self.blocks = rows, *block
        self.column = np.full(256, len(symbols), np.int64)
        self.column[symbols] = np.arange(len(symbols))
        self.contexts = {}
        for size in range(DEPTH + 1):
            mine = np.flatnonzero(length == size)
            # Contexts of up to four bytes; narrow keys keep the searched array in cache.
            keys = context[mine].astype(np.uint32)
            order = np.argsort(keys)
            self.contexts[size] = (keys[order], mine[order])

    def log10(self, text: str | None) -> float:
        """What this block's contexts give of the text's log10 probability."""
        grams = text_grams(text)
        if self.blocks > 1:
            pair = grams >> np.uint64(8) & np.uint64(0xFFFF)
            grams = grams[pair % np.uint64(self.blocks) == self.number]
        column = self.column[(grams & np.uint64(255)).astype(np.int64)]
        context, total = (grams >> np.uint64(8)).astype(np.uint32), 0.0
        for size in range(DEPTH, -1, -1):
            keys, place = self.contexts[size]
            at, known = lookup(keys, context & np.uint32((1 << (8 * size)) - 1))
            if known.any():
                total += float(self.rows[place[at[known]], column[known]].sum(dtype=float))
            context, column = context[~known], column[~known]
            if not len(context):
                break
        return total


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts of `docs`; the end of a text is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()))]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "c"])

        for part in slices(batches):
            for text in part.column(0).to_pylist():
                counts.update(utf8(text).lower().split())
                counts[b""] += 1
            if len(counts) > 1_000_000:
                yield flush()
        if counts:
            yield flush()

    sent = docs.select("text").mapInArrow(run, "word binary, c long")
    return sent.groupBy("word").agg(F.sum("c").alias("c"))


def scored(docs: DataFrame, held_out: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of `docs`.

    `docs` has doc_id, text and the boolean column `held_out`; where it is not
    true the models learn. Tokens are the words of the text in lower case and
    one end. score is the log10 probability of the text's bytes (A-Z lowered)
    and its end; its code length per byte is -score / (log10(2) * bytes).
    A NULL text is empty: one token. Repeated rows are scored each. With no
    training texts the base is uniform and the tree gives 1/256 per byte. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ctw")
    docs = numbered(docs.select("doc_id", "text", F.col(held_out).alias("held_out")), "row")
    training = docs.where(~F.col("held_out"))
    tree = Tree(scratch.save(counted_grams(training)), scratch)
    words = scratch.save(word_counts(training))
    total, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # Words of at least a share of 1 / FREQUENT: there are FREQUENT of them at most.
    often = words.where(F.col("c") * FREQUENT >= total)
    known = spark.sparkContext.broadcast(dict((bytes(w), c) for w, c in often.toLocalIterator()))
    tables = [spark.sparkContext.broadcast(tree.block(i)) for i in range(tree.blocks)] if kinds else []
    uniform = -math.log10(256)

    def first():
        table = tables[0].value if tables else None
        frequent = known.value

        def function(texts):
            tokens, there, logs, scores, rare, rare_n = [], [], [], [], [], []
            for text in texts:
                counts = Counter(utf8(text).lower().split())
                counts[b""] += 1
                hits, log, others, other_n = 0, 0.0, [], []
                for word, n in counts.items():
                    c = frequent.get(word)
                    if c is None:
                        others.append(word)
                        other_n.append(n)
                    else:
                        hits += n
                        log += n * math.log10(c + 0.5)
                tokens.append(counts.total())
                there.append(hits)
                logs.append(log)
                rare.append(others)
                rare_n.append(other_n)
                scores.append(
                    table.log10(text) if table else uniform * (len(utf8(text)) + 1)
                )
            return tokens, there, logs, scores, rare, rare_n

        return function

    fields = T.StructType.fromDDL(
        "n_tokens long, hits long, logs double, score double, rare array<binary>, rare_n array<long>"
    ).fields
    found = append_columns(docs, ["text"], fields, first).drop("text")
    found = scratch.save(found)
    rare = found.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("n"))
    seldom = words.where(F.col("c") * FREQUENT < total)
    count = F.coalesce("c", F.lit(0))
    rare = rare.join(seldom, "word", "left").groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("rare_hits"),
        F.sum(F.col("n") * F.log10(count + 0.5)).alias("rare_logs"),
    )
    rest = [_block_scores(docs, t) for t in tables[1:]]
    result = found.drop("rare", "rare_n").join(rare, "row", "left")
    score = F.col("score")
    if rest:
        more = rest[0]
        for part in rest[1:]:
            more = more.union(part)
        more = more.groupBy("row").agg(F.sum("part").alias("more"))
        result = result.join(more, "row")
        score = score + F.col("more")
    base = math.log10(total + 0.5 * (kinds + 1))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return result.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hits") + F.coalesce("rare_hits", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * base).alias("base_score"),
        score.alias("score"),
    )


def _block_scores(docs: DataFrame, table) -> DataFrame:
    def factory():
        return lambda texts: [[table.value.log10(t) for t in texts]]

    field = T.StructField("part", T.DoubleType())
    return append_columns(docs.select("row", "text"), ["text"], [field], factory).drop("text")
