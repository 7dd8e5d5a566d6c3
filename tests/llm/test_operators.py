"""The dealt operators against plain versions, and on rows that have every oddity."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm import (
    components,
    context_trees,
    hilbert_shards,
    itq_dedup,
    letter_profiles,
    pareto_mix,
    simhash_trie,
    tier_packing,
    token_transducer,
    toxicity_models,
    weighted_minhash,
)
from llm.common import Scratch, numbered
from llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, score string"


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, empty, blank and long texts, repeated rows and ids, clashing names."""
    rows = [
        (1, None, None, None, None, None, None),
        (2, "", "en", "a", 0, "x", "y"),
        (3, " \t\n", "en", "a", 3, "x", "y"),
        (None, "one two three four", "en", "b", 18, "x", "y"),
        (None, "one two three four", "en", "b", 18, "x", "y"),
        (5, "one two three four", "en", None, 18, "x", "y"),
        (5, "one two three four", "en", None, 18, "x", "y"),
        (6, "l'été à la plage " * 3000, "fr", "b", 50000, "x", "y"),
        (7, "x" * 30000, None, "c", 30000, "x", "y"),
        (8, "123 456 !!! <|endoftext|>", "en", "c", 25, "x", "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def result(spark, name):
    return QUERIES[name](spark, SF).toPandas()


def least_components(n, links):
    label = list(range(n))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        label[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(df, Scratch(spark, "t")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def test_trie_finds_all_pairs_and_no_other():
    rng = np.random.default_rng(3)
    near = np.uint64(77) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    values = np.unique(np.concatenate([rng.integers(0, 1 << 63, 2000, np.uint64), near]))
    found = set()
    for i, j in simhash_trie.trie_links(values, values, 3):
        found |= set(zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist(), strict=True))
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    assert found == {(a, b) for a, b in np.argwhere(apart <= 3).tolist() if a <= b}


def plain_fingerprint(text):
    tokens = words(text)
    shingles = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles if s]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op10(spark, documents):
    found = result(spark, "op10_simhash_trie").set_index("doc_id").loc[documents.doc_id]
    prints = [plain_fingerprint(t) for t in documents.text]
    assert found.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    values = np.array(prints, np.uint64)
    links = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    ids = documents.doc_id.tolist()
    assert ids == sorted(ids)
    assert found.component_id.tolist() == [ids[i] for i in least_components(len(ids), links)]


def test_op10_odd_rows(spark, odd, empty):
    found = simhash_trie.near_duplicates(numbered(odd.drop("row"), "row")).toPandas()
    assert len(found) == 10 and found.groupby("component_id", dropna=False).keep.sum().eq(1).all()
    blank = found[found.doc_id.isin([1, 2, 3])]
    assert (blank.fp == 0).all() and (blank.component_id == 1).all()
    assert (found[found.doc_id.isna()].component_id == 5).all()
    assert simhash_trie.one_per_group(odd).columns == odd.columns
    assert simhash_trie.one_per_group(odd).where("text like 'one%'").count() == 1
    assert simhash_trie.one_per_group(empty).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, unit string")


@pytest.mark.parametrize("block_rows", [2048, 8])
def test_op1_equals_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(itq_dedup, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 16))
    near = base[:30] + 0.05 * rng.standard_normal((30, 16))
    chain = [base[0] * np.cos(a) + base[1] * np.sin(a) for a in np.linspace(0, 1.2, 12)]
    every = np.concatenate([base, near, chain, base[:5], base[:5]]).astype(np.float32)
    label = [i % 2 for i in range(60)] + [i % 2 for i in range(30)] + [0] * 12 + [0, 1, 0, 1, 0] * 2
    rows = [(i, v.tolist(), c, None) for i, (v, c) in enumerate(zip(every, label, strict=True))]
    found = itq_dedup.near_duplicates(vectors(spark, rows)).toPandas().sort_values("vec_id")
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    close = (unit @ unit.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(close, False)
    assert close.sum() > 60
    assert found.n_links.tolist() == close.sum(axis=1).tolist()
    assert found.component_id.tolist() == least_components(len(every), np.argwhere(close))
    assert (found.kept == (found.vec_id == found.component_id)).all()


def test_op1_odd_rows(spark):
    good = [1.0, 2.0, 3.0]
    rows = [
        (1, None, 1, None),
        (2, [0.0, 0.0, 0.0], 1, None),
        (3, [1.0, None, 2.0], 1, None),
        (4, [1.0, float("nan"), 2.0], 1, None),
        (5, [float("inf"), 1.0, 1.0], 1, None),
        (6, [], 1, None),
        (7, good, None, None),
        (8, good, 1, None),
        (9, [2.0, 4.0, 6.0], 1, None),
        (9, good, 1, None),
        (None, good, 1, None),
        (10, [1.0, 2.0], 1, None),
    ]
    found = itq_dedup.near_duplicates(vectors(spark, rows)).toPandas()
    assert len(found) == len(rows)
    linked = found[found.n_links > 0]
    assert len(linked) == 4 and (linked.n_links == 3).all() and (linked.component_id == 8).all()
    alone = found[found.n_links == 0]
    assert (alone.component_id == alone.vec_id).all() and alone.kept.all()
    assert itq_dedup.near_duplicates(vectors(spark, [])).count() == 0


def test_op2_accuracy(spark):
    found = QUERIES["op2_letter_profiles"](spark, "/root/testdata/sf0.01").toPandas()
    truth = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").set_index("doc_id").lang
    held = found[found.held_out]
    assert (held.lang_pred == held.doc_id.map(truth)).mean() >= 0.98
    assert found.score.between(0, 1).all()
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(found.doc_id, found.held_out, strict=True))


def test_op2_odd_rows(spark, odd, empty):
    learned = letter_profiles.prototypes(odd)
    assert set(learned) == {"en", "fr"}
    found = letter_profiles.with_language(odd, learned, ("p", "s")).toPandas()
    assert (found[found.text.isna() | found.doc_id.isin([2, 3])].p == "und").all()
    assert found[found.doc_id == 6].p.item() == "fr"
    assert letter_profiles.prototypes(empty) == {}
    unknown = letter_profiles.with_language(odd, {}, ("p", "s")).toPandas()
    assert (unknown.p == "und").all() and (unknown.s == 0).all()


def test_op3_round_trip(spark, documents):
    found = result(spark, "op3_tier_packing")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoded = tokenizer.encode_batch(documents.text.tolist(), add_special_tokens=False)
    ids = {i: np.array([*e.ids, 2], "<u4") for i, e in zip(documents.doc_id, encoded, strict=True)}
    for r in found.itertuples():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32 and len(ids[r.doc_id]) == r.doc_tokens
    by_start = found.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert (by_start.length.cumsum() - found.length == found.start).all()
    assert (by_start.length.sum() == pd.Series({i: len(x) for i, x in ids.items()})).all()
    by_offset = found.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (by_offset.length.cumsum() - found.length == found.offset).all()
    held, window = by_offset.length.sum(), by_offset.window.first()
    assert (held <= window).all() and (window[held < window] == 4096).all() and (held < window).sum() <= 1


def test_op3_odd_rows(spark, odd, empty):
    found = tier_packing.packed(odd).toPandas()
    assert (found[found.doc_id.isin([1, 2, 3])].doc_tokens == 1).all()
    assert found.length.sum() == found.drop_duplicates(["doc_id", "doc_tokens"]).doc_tokens.sum() + 2 * 5
    assert tier_packing.packed(empty).count() == 0


ALPHABET = "aabcdeeghiklmnorstuvw  \t\n\r'stremvld0123.,!?<|>éü中文😀\x85\xa0\x1c　́ABCΣİ-_"


def random_texts(n, seed):
    rng = np.random.default_rng(seed)
    texts = ["".join(rng.choice(list(ALPHABET), rng.integers(0, 30))) for _ in range(n)]
    return [t[:4] + "<|endoftext|>" + t[4:] if i % 9 == 0 else t for i, t in enumerate(texts)]


def test_op3_ids_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    ours, theirs = tier_packing.WordIds(path), Tokenizer.from_file(path)
    texts = random_texts(3000, 1)
    for text, ids in zip(texts, ours(texts), strict=True):
        assert ids.tolist() == [*theirs.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_op5_equals_the_library(spark, documents):
    found = result(spark, "op5_token_transducer").set_index("doc_id").loc[documents.doc_id]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert found.n_tokens.tolist() == [len(e.ids) for e in tokenizer.encode_batch(documents.text.tolist())]
    assert found.n_bytes.tolist() == [len(t.encode()) for t in documents.text]


def test_op5_state_maps_compose():
    path = public_tokenizers.path("byte_bpe_50k.json")
    ours, theirs = token_transducer.Counter(path), Tokenizer.from_file(path)
    for text in random_texts(2000, 2):
        wanted = len(theirs.encode(text).ids)
        for size in (1, 3, 100):
            maps = [ours.state_map(text[i : i + size]) for i in range(0, len(text), size)]
            assert ours.total(maps or [ours.state_map("")]) == wanted, repr(text)


def test_op5_odd_rows(spark, odd, empty):
    whole = token_transducer.counted(odd).toPandas().sort_values("row")
    cut = token_transducer.counted(odd, chunk=1000).toPandas().sort_values("row")
    assert len(whole) == 10 and whole.n_tokens.tolist() == cut.n_tokens.tolist()
    assert whole.n_bytes.tolist() == cut.n_bytes.tolist()
    assert (whole[whole.doc_id.isin([1, 2])].n_tokens == 0).all()
    assert token_transducer.counted(empty).count() == 0


def test_op4(spark, documents):
    found = result(spark, "op4_hilbert_shards")
    sizes = found.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert sizes["count"].max() - sizes["count"].min() <= 1 and len(sizes) == 8
    assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["nunique"] - 1).all()
    texts = found.doc_id.map(documents.set_index("doc_id").text)
    assert [len(t.encode()) + 1 for t in texts] == found["size"].tolist()
    assert [zlib.crc32(t.encode()) for t in texts] == found.text_crc32.tolist()


def test_op4_equal_texts_are_neighbours(spark, documents):
    """Only the cuts between shards part equal texts, and one group each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = hilbert_shards.sharded(docs).toPandas().sort_values("position")
    found["text"] = found.doc_id.map(documents.set_index("doc_id").text)
    runs = (found.text != found.text.shift()).sum()
    assert runs == found.text.nunique() < len(found)
    assert (found.groupby("text").curve.nunique() == 1).all()
    parted = (found.groupby("text").shard.nunique() > 1).sum()
    assert parted <= 7


def test_op4_strings_are_told_apart_as_wholes(spark):
    """Sources that share a long beginning have cells of their own, in order, frequent or not."""
    names = [f"https://example.org/a/long/beginning/{i:03}" for i in range(40)] + [None]
    rows = [(i, f"text {i}", names[min(40, i % 60)], "en", 7) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    scratch = Scratch(spark, "t")
    cuts = hilbert_shards._string_cuts(docs, "source", 6, scratch)
    assert cuts == names[:40]
    # Seven cells of forty strings: each starts at the first place that is its share.
    starts = [names[math.ceil(40 * c / 7)] for c in range(7)]
    assert hilbert_shards._string_cuts(docs, "source", 3, scratch) == starts
    one = hilbert_shards.with_curve_index(docs.select("doc_id", "source"), ("source",), scratch).toPandas()
    cells = dict(zip(one.source, one.curve, strict=True))
    assert [cells[n] for n in [None, *names[:40]]] == list(range(41))


def test_op4_curve_is_a_path():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    index = hilbert_shards.hilbert_index(cells, 3)
    path = cells[np.argsort(index)]
    assert sorted(index.tolist()) == list(range(512))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_op4_odd_rows(spark, odd, empty):
    found = hilbert_shards.sharded(odd, shards=3).toPandas()
    assert sorted(found.groupby("shard").size()) == [3, 3, 4] and found.position.nunique() == 10
    assert found[found.doc_id == 1]["size"].item() == 1
    assert hilbert_shards.sharded(empty).count() == 0


def plain_targets(sizes):
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    capped: dict[int, float] = {}
    while True:
        left = sum(sizes) - sum(capped.values())
        total = sum(w for i, w in enumerate(weight) if i not in capped)
        share = {i: left * weight[i] / total for i in range(len(sizes)) if i not in capped}
        over = {i: 3.0 * sizes[i] for i, s in share.items() if s > 3 * sizes[i]}
        if not over:
            return [capped.get(i, share.get(i)) for i in range(len(sizes))]
        capped |= over


def test_op8(spark, documents):
    found = result(spark, "op8_pareto_mix").merge(documents, on="doc_id")
    assert found["size"].tolist() == [len(words(t)) for t in found.text]
    sums = found.groupby("source")[["size", "taken"]].sum().sort_index()
    first = found.groupby("source")[["source_size", "target"]].first().sort_index()
    assert (sums["size"] == first.source_size).all()
    assert np.allclose(first.target, plain_targets(first.source_size.tolist()))
    assert (found.taken <= 3 * found["size"]).all() and (found.taken % found["size"].clip(lower=1) == 0).all()
    largest = found.groupby("source")["size"].max()
    assert ((sums.taken - first.target).abs() <= largest).all()
    again = result(spark, "op8_pareto_mix")
    assert Counter(map(tuple, found[again.columns].values.tolist())) == Counter(map(tuple, again.values.tolist()))


def test_op8_odd_rows(spark, odd, empty):
    found = pareto_mix.sampled(numbered(odd.drop("row"), "row"), Scratch(spark, "t")).toPandas()
    assert len(found) == 10 and found.copies.between(0, 3).all()
    assert found[found.source.isna()].source_size.eq(8).all()
    assert pareto_mix.mixed(odd).columns == odd.columns
    assert pareto_mix.mixed(empty).count() == 0


def test_op8_fills_behind_a_long_document(spark):
    """A document longer than what is missing ends no source: later buckets hold some that fit."""
    texts = ["w " * 30] * 1500 + ["w " * 60_000]
    rows = [(i, t, s) for s in "abcdef" for i, t in enumerate(texts, 10_000 * ord(s))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = pareto_mix.sampled(numbered(docs, "row"), Scratch(spark, "t")).toPandas()
    taken = (found["size"] * found.copies).groupby(found.source).sum()
    target = found.groupby("source").target.first()
    assert ((taken - target).abs() <= 15).all()


def test_op9(spark, documents):
    found = result(spark, "op9_weighted_minhash").set_index("doc_id")
    rows = documents.sort_values("doc_id", ascending=False)
    texts = rows.text.tolist()
    following = texts[1:] + texts[:1]
    changed = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(texts, following, strict=True)]
    found = found.loc[rows.doc_id]
    assert found.edited_sha256.tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    assert found.n_chars.tolist() == [len(t) for t in texts]

    def jaccard(a, b):
        a, b = Counter(a.encode().split()), Counter(b.encode().split())
        return (a & b).total() / max(1, (a | b).total())

    exact = np.array([jaccard(a, b) for a, b in zip(texts, changed, strict=True)])
    error = found.near_edited.to_numpy() - exact
    assert abs(error.mean()) < 0.02 and np.sqrt((error**2).mean()) < 0.06
    prints = dict(zip(texts, found.fingerprint, strict=True))
    assert all(prints[t] == p for t, p in zip(texts, found.fingerprint, strict=True))


def test_op9_many_words():
    """Words share no random numbers, however many a text has, and the table changes nothing."""
    races = weighted_minhash.Races(1024, weighted_minhash.SEED)
    one, other = (" ".join(f"{c}{i}" for i in range(20_000)) for c in "ab")
    assert weighted_minhash.likeness(races.of_text(one), races.of_text(other)) < 0.005
    half = " ".join(one.split()[:10_000]) + " " + other
    near = weighted_minhash.likeness(races.of_text(half), races.of_text(other))
    assert abs(near - 2 / 3) < 0.06
    repeated = one + " a1 a1 a2 b3 b3"
    for kept in (0, 100, 25_000):
        short = weighted_minhash.Races(1024, weighted_minhash.SEED, kept)
        assert all(short.of_text(t) == races.of_text(t) for t in (repeated, half, one))


def test_op9_odd_rows(spark, odd, empty):
    found = weighted_minhash.fingerprinted(odd).toPandas()
    assert len(found) == 10
    copies = found[found.n_chars == 18]
    assert copies.fingerprint.nunique() == 1
    assert set(found[found.doc_id.isin([1, 2, 3])].fingerprint) == {"0" * 4 * weighted_minhash.SAMPLES}
    single = weighted_minhash.fingerprinted(odd.where("doc_id = 8")).toPandas()
    assert single.near_next.item() == 1.0
    assert weighted_minhash.fingerprinted(empty).count() == 0


def test_op6_base_and_bits(spark, documents):
    found = result(spark, "op6_context_trees").set_index("doc_id").loc[documents.doc_id]
    tokens = [[*words(t), b""] for t in documents.text]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in documents.doc_id]
    counts = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    total, kinds = counts.total(), len(counts)
    assert set(found.train_tokens) == {total} and found.held_out.tolist() == held
    base = [sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws) for ws in tokens]
    assert np.allclose(found.base_score, base)
    assert found.n_known.tolist() == [sum(counts[w] > 0 for w in ws) for ws in tokens]
    size = np.array([len(t.encode()) + 1 for t in documents.text])[held]
    assert 1.5 < -found.score[held].sum() / math.log10(2) / size.sum() < 3.2


def test_op6_is_a_distribution_and_blocks_add_up(spark, odd, monkeypatch):
    docs = odd.withColumn("held", F.lit(False))
    one = context_trees.scored(docs, "held").toPandas().sort_values(["doc_id", "n_tokens"])
    scratch = Scratch(spark, "t")
    tree = context_trees.Tree(scratch.save(context_trees.counted_grams(odd)), scratch)
    block = tree.block(0)
    known = len(tree.symbols)
    mass = (10.0 ** block.rows[:, :known]).sum(axis=1) + (256 - known) * 10.0 ** block.rows[:, known]
    assert np.allclose(mass, 1, atol=1e-3)
    monkeypatch.setattr(context_trees, "BLOCK_ROWS", 20)
    several = context_trees.scored(docs, "held").toPandas().sort_values(["doc_id", "n_tokens"])
    assert np.allclose(one.score, several.score, rtol=1e-5) and len(one) == 10


def test_op6_one_context_by_hand():
    """A tree of one byte under one context, mixed along its path, against the definition."""
    counts = np.zeros((1, 256))
    counts[0, 65] = 3
    block, ones = context_trees.estimates(counts)
    # Three equal decisions: 1/2 * 3/4 * 5/6.
    assert np.isclose(np.exp(block[0, 1]), 5 / 16) and np.isclose(ones[0, 1], 0.5 / 4)
    total, weight = context_trees.weighted(block, block)
    assert np.allclose(total, block) and np.allclose(weight, 0.5)


def test_op6_no_training(spark, odd, empty):
    found = context_trees.scored(odd.withColumn("held", F.lit(True)), "held").toPandas()
    assert (found.train_tokens == 0).all() and (found.n_known == 0).all()
    assert context_trees.scored(empty.withColumn("held", F.lit(False)), "held").count() == 0


def test_op7_separates_planted_words(spark):
    rng = np.random.default_rng(8)
    plain = ["river", "stone", "under", "cloud", "window", "paper", "green", "seven", "morning"]
    rows, labels = [], []
    for i in range(800):
        text = list(rng.choice(plain, 60))
        if i % 5 == 0:
            text[:: 20] = rng.choice(["zorgul", "vexnak"], 3)
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    fit = toxicity_models.fitted(docs, marks)
    found = toxicity_models.with_score(docs, fit, "score").toPandas()
    held = found[[zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]]
    assert ((held.score >= 0.3) == (held.doc_id % 5 == 0)).all() and held.score.between(0, 1).all()


def test_op7_odd_rows(spark, odd, empty):
    labels = [(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 1), (6, 7), (8, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    fit = toxicity_models.fitted(odd, labels)
    found = toxicity_models.with_score(odd, fit, "p").toPandas()
    assert found.p.between(0, 1).all() and len(found) == 10
    nothing = toxicity_models.fitted(empty, labels)
    assert (toxicity_models.with_score(odd, nothing, "p").toPandas().p == 0).all()


def test_pipeline_stages(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"
    for frame in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            done = stage(spark, frame, SF)
            assert name == "packing" or done.columns == frame.columns
            assert done.count() >= 0
    kept = corpus_pipeline.language(spark, docs, SF)
    gone = docs.join(kept, "doc_id", "left_anti").toPandas()
    assert len(gone) <= 0.01 * docs.count()
    unique = corpus_pipeline.near_duplicates(spark, docs, SF)
    groups = QUERIES["op10_simhash_trie"](spark, SF)
    assert unique.count() == groups.select("component_id").distinct().count()
    assert unique.join(groups.where("doc_id = component_id"), "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() > 0


def test_op3_ids_of_all_characters():
    """Every character before and behind punctuation, as the library's rules take it apart."""
    path = public_tokenizers.path(tier_packing.VOCABULARY)
    own, library = tier_packing.word_ids(path), Tokenizer.from_file(path)
    changing = [c for c in map(chr, range(0x110000)) if c.lower() != c or not c.isascii() and c.isalpha()]
    changing = [c for c in changing if unicodedata.normalize("NFC", c.lower()) != c]
    assert {"क़", "ड़", "ড়", "য়", "İ"} <= set(changing)
    rng = np.random.default_rng(12)
    some = [chr(c) for c in rng.integers(0, 0x110000, 4000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}!b {c}. x{c}{c}?{c}'s {c}" for c in [*changing, *some]]
    pool = [*changing[:400], *some[:400], *"ab.,!'s \t़́​"]
    texts += ["".join(rng.choice(pool, rng.integers(0, 25))) for _ in range(4000)]
    expected = library.encode_batch(texts, add_special_tokens=False)
    for text, ids, found in zip(texts, own(texts), expected, strict=True):
        assert ids.tolist() == [*found.ids, tier_packing.END], ascii(text)


def test_op3_frequent_stems_stay_remembered(monkeypatch):
    """Rare words pass through a full memory without costing the frequent ones theirs."""
    monkeypatch.setattr(tier_packing, "CACHE_WORDS", 100)
    path = public_tokenizers.path(tier_packing.VOCABULARY)
    own, library = tier_packing.WordIds(path), Tokenizer.from_file(path)
    encoded, together = [], own._together
    monkeypatch.setattr(own, "_together", lambda parts: encoded.extend(parts) or together(parts))
    letters = "abcdefghij"
    for i in range(60):
        rare = " ".join(f"z{letters[i // 10]}{letters[i % 10]}{c}{d}" for c in "klm" for d in letters)
        text = f"The frequent, frequent! word {rare}"
        [ids] = own([text])
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
        assert len(own.recent) + len(own.older) <= 100
    assert encoded.count("frequent") == encoded.count("word") == 1
    assert len(encoded) < 60 * 30 + 10


def test_op9_texts_together_equal_texts_alone(monkeypatch):
    """Which texts are looked up at once, and what is kept, changes no signature."""
    rng = np.random.default_rng(13)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 300))) for _ in range(60)]
    texts += ["", " \x0b\t ", "a a a b", "\x1c one\x85two ", texts[0] * 3]
    whole = weighted_minhash.Races(64, 1).signatures(texts)
    assert [whole[i] is None for i in (-5, -4, -3)] == [True, True, False]
    short = weighted_minhash.Races(64, 1, 50)
    assert [short.of_text(t) for t in texts] == whole
    monkeypatch.setattr(weighted_minhash, "TOGETHER", 500)
    monkeypatch.setattr(weighted_minhash, "BLOCK", 40)
    assert weighted_minhash.Races(64, 1).signatures(texts) == whole


def test_op9_neighbours_across_batches(spark, monkeypatch):
    """Rows of a part that arrive in several batches have the same neighbours as in one."""
    docs = spark.createDataFrame([(i, f"t{i} common words " * (i % 4)) for i in range(90)], "doc_id long, text string")
    rows = {r.doc_id: r for r in weighted_minhash.fingerprinted(docs).collect()}
    monkeypatch.setattr(weighted_minhash, "slices", lambda batches: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    again = {r.doc_id: r for r in weighted_minhash.fingerprinted(docs).collect()}
    assert len(rows) == 90 and rows == again


def test_language_stage_at_every_length(spark):
    """A text in no known language goes, a paragraph as well as a page; short known ones stay."""
    known = {
        "en": "the river runs under the old bridge and the children of the town play there every morning",
        "de": "der fluss fliesst unter der alten brücke und die kinder der stadt spielen dort jeden morgen",
    }
    rng = np.random.default_rng(14)
    rows = []
    for lang, text in known.items():
        for i in range(120):
            rows.append((len(rows), " ".join(rng.permutation(text.split())[: 1 + i % 15]), lang))
    chinese = "中文的句子没有任何共同之处这是一个测试文本用来检查语言识别的效果如何我们希望它被拒绝因为没有学过"
    russian = (
        "Это текст на русском языке, в котором нет ни одной латинской буквы, поэтому он не похож на "
        "выученные языки. Чем длиннее страница, тем меньше случайное сходство мешает это заметить: "
        "короткие строки судить трудно, а здесь уже достаточно разных сочетаний соседних букв, чтобы "
        "отличить чужую письменность от знакомой и убрать документ из корпуса."
    )
    aliens = [chinese, chinese * 8, "Αυτό είναι ένα κείμενο στα ελληνικά", russian]
    rows += [(1000 + i, t, None) for i, t in enumerate([*aliens, None, "", "123 !!"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, SF).collect()}
    assert kept == set(range(240))


def test_op2_equals_plain_profiles(spark):
    """Cosines of sums of bound vectors, letter by letter."""
    texts = ["Ab, ab c!", "ünder der", "", "77", "aaaa aaaa b"]
    learned_from = [("x", "abra cadabra ab"), ("x", "bar"), ("y", "der hund und der"), (None, "zzz")]
    rows = [(i, t, lang) for i, (lang, t) in enumerate(learned_from)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    vectors = letter_profiles.Vectors()

    def plain(text):
        letters = "".join(c.lower() if c.isalpha() else "\0" for c in f"\0{text}\0")
        letters = re.sub("\0+", "\0", letters)
        total = np.zeros(letter_profiles.DIMENSIONS)
        for trigram in zip(letters, letters[1:], letters[2:], strict=False):
            bound = np.ones(letter_profiles.DIMENSIONS)
            for turns, c in zip((2, 1, 0), trigram, strict=True):
                drawn = np.random.Generator(np.random.PCG64([letter_profiles.SEED, ord(c) if c != "\0" else 0]))
                bound *= np.roll(drawn.integers(0, 2, letter_profiles.DIMENSIONS, np.int8) * 2 - 1, turns)
            total += bound
        return total if letters.strip("\0") else np.zeros(letter_profiles.DIMENSIONS)

    prototypes = {"x": plain("abra cadabra ab") + plain("bar"), "y": plain("der hund und der")}
    learned = letter_profiles.prototypes(labelled)
    assert {k: v.tolist() for k, v in learned.items()} == {k: v.tolist() for k, v in prototypes.items()}
    assert vectors.dimensions == letter_profiles.DIMENSIONS
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in letter_profiles.with_language(df, learned, ("lang", "score", "n")).collect():
        own = plain(row.text)
        cosines = {k: own @ v / max(1e-9, np.linalg.norm(own)) / np.linalg.norm(v) for k, v in prototypes.items()}
        best = max(sorted(cosines), key=cosines.get) if own.any() else "und"
        assert row.lang == best and abs(row.score - max(0, cosines.get(best, 0))) < 1e-4
        assert (row.n > 0) == own.any()


def test_op5_characters_that_are_classed_apart():
    """Characters that newer tables take as letters or numbers count as the library has them."""
    path = public_tokenizers.path(token_transducer.VOCABULARY)
    own, library = token_transducer.counter(path), Tokenizer.from_file(path)
    ranges = [r.split("-") for r in token_transducer.NEITHER.split()]
    codes = [c for r in ranges for c in range(int(r[0], 16), int(r[-1], 16) + 1)]
    rng = np.random.default_rng(15)
    others = [int(c) for c in rng.integers(0, 0x110000, 3000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}'s {c}!1{c}  {c}{c} x" for c in map(chr, [*codes[::7], *others])]
    pool = [*map(chr, codes[::50]), *map(chr, others[:300]), *"ab1 '\n\ts"]
    texts += ["".join(rng.choice(pool, rng.integers(0, 25))) for _ in range(3000)]
    expected = library.encode_batch(texts, add_special_tokens=False)
    for text, found in zip(texts, expected, strict=True):
        assert own.count(text) == len(found.ids), ascii(text)
