"""Mixing sources to target weights by Pareto order sampling (operator 8).

Each source has a target in words. Its rate (target / size) gives every
document certain whole copies, and a further copy with probability equal to
the fractional part. Those further copies are a Pareto sample of fixed size:
documents are ranked by random odds over inclusion odds, and the first ones are
taken until the words still missing are reached. The inclusion odds are equal
within a source, so that its ranking is plain random order.

The cut of a ranking is found without sorting a source: ranks fall into
buckets, bucket sums say in which one the cut lies, and only that bucket's
documents are ordered. Documents that would overshoot are passed over, and the
words still missing are sought in the buckets after the cut, by sums of what
still fits, until no document left is short enough. One more is then taken if
overshooting by the shortest comes nearer than falling short.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import Scratch, fresh, numbered

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
# Documents per bucket of a ranking, and buckets per source at most.
BUCKET_ROWS = 256
MOST_BUCKETS = 1 << 14
SEED = 20_240_229


def word_count(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: pd.DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_COPIES
) -> pd.DataFrame:
    """Targets of sources (source, source_size), which come in weight order.

    The total is shared by weight; a target above `most` times its source is
    cut to that, and what is cut off is shared again among the others.
    """
    size = sizes["source_size"].to_numpy(float)
    weight = [weights[i % len(weights)] for i in range(len(size))]
    target, open_, left = [0.0] * len(size), set(range(len(size))), float(size.sum())
    while open_:
        total = sum(weight[i] for i in open_)
        over = {i for i in open_ if left * weight[i] / total > most * size[i]}
        for i in over or open_:
            target[i] = most * size[i] if over else left * weight[i] / total
        if not over:
            break
        left -= sum(target[i] for i in over)
        open_ -= over
    return sizes.assign(target=target)


def with_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, rows, number) of each source of `sized` (source, size).

    Sources are ordered by code point (bytes of UTF-8), NULL last. The number of
    sources, not of documents, bounds what the driver holds.
    """
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    found = [tuple(r) for r in per_source.collect()]
    found.sort(key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
    frame = pd.DataFrame(found, columns=["source", "source_size", "rows"])
    done = source_targets(frame)
    columns = zip(done["source"], done["source_size"], done["rows"], done["target"], strict=True)
    rows = [(s, int(n), int(k), float(t), i) for i, (s, n, k, t) in enumerate(columns)]
    return sized.sparkSession.createDataFrame(
        rows, "source string, source_size long, rows long, target double, number int"
    )


def _fill(part: pd.DataFrame) -> pd.DataFrame:
    """The documents of one source's cut bucket that are taken, in rank order."""
    part = part.sort_values(["rank", "doc_id", "tie", "row"], na_position="last")
    gap, taken = float(part["gap"].iloc[0]), []
    for size in part["size"]:
        taken.append(size <= gap)
        gap -= size * taken[-1]
    return part.loc[taken, ["row", "number", "size"]]


def _extras(ranked: DataFrame, missing: dict[int, float], scratch: Scratch) -> DataFrame:
    """(row) of the further copies: each source of `missing` (number: words) in rank order.

    A document is taken if it fits into what its source still misses. In a round
    the documents that fit at its start are summed by bucket: all of them are
    taken up to the bucket in which their sums exceed the gap, and that one is
    gone through in order. The next round goes on behind it with the gap left.
    The driver holds a row per source and round; each round has a smaller gap,
    and a source has no more of them than buckets.
    """
    spark = ranked.sparkSession
    ranked = ranked.where(F.col("rank").isNotNull())
    spans: list[tuple] = []
    picked = spark.createDataFrame([], "row long, number int, size long")
    gaps, open_ = dict(missing), {n: 0 for n, gap in missing.items() if gap > 0}
    while open_:
        state = [(n, start, gaps[n]) for n, start in open_.items()]
        state = spark.createDataFrame(state, "number int, start int, gap double")
        # Documents without words belong to the first round: they fit everywhere.
        fits = (F.col("bucket") >= F.col("start")) & (F.col("size") <= F.col("gap"))
        fits = fits & ((F.col("size") > 0) | (F.col("start") == 0))
        left = ranked.join(F.broadcast(state), "number").where(fits)
        # Sums per source and bucket; what comes of them is one row per source.
        sums = left.groupBy("number", "bucket", "gap").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(W.partitionBy("number").orderBy("bucket"))
        sums = sums.withColumn("upto", upto)
        over = F.col("upto") > F.col("gap")
        cuts = sums.groupBy("number").agg(
            F.min(F.when(over, F.col("bucket"))).alias("cut"),
            F.coalesce(F.max(F.when(~over, F.col("upto"))), F.lit(0)).alias("words"),
        )
        cuts = {r["number"]: (r["cut"], r["words"]) for r in cuts.collect()}
        following, inside = {}, []
        for n, start in open_.items():
            cut, taken = cuts.get(n, (None, 0))
            spans.append((n, start, MOST_BUCKETS if cut is None else cut, gaps[n]))
            gaps[n] -= taken
            if cut is not None:
                inside.append((n, cut, gaps[n]))
                following[n] = cut + 1
        if inside:
            inside = spark.createDataFrame(inside, "number int, bucket int, gap double")
            within = left.drop("gap").join(F.broadcast(inside), ["number", "bucket"])
            within = within.select("number", "row", "doc_id", "tie", "rank", "size", "gap")
            filled = within.groupBy("number").applyInPandas(_fill, picked.schema)
            filled = scratch.save(filled)
            for n, taken in filled.groupBy("number").agg(F.sum("size")).collect():
                gaps[n] -= taken
            picked = picked.union(filled)
        open_ = {n: start for n, start in following.items() if gaps[n] > 0}
    spans = spark.createDataFrame(spans, "number int, start int, stop int, gap double")
    spans = spans.groupBy("number").agg(F.collect_list(F.struct("start", "stop", "gap")).alias("spans"))

    def within_span(span: Column) -> Column:
        whole = (F.col("bucket") >= span["start"]) & (F.col("bucket") < span["stop"])
        fits = (F.col("size") <= span["gap"]) & ((F.col("size") > 0) | (span["start"] == 0))
        return whole & fits

    taken = ranked.join(F.broadcast(spans), "number").where(F.exists("spans", within_span))
    taken = scratch.save(taken.select("row").union(picked.select("row")))
    # One document more if overshooting by it comes nearer than falling short.
    short = [(n, gap) for n, gap in gaps.items() if gap > 0]
    short = spark.createDataFrame(short, "number int, gap double")
    near = (F.col("size") > 0) & (F.abs(F.col("size") - F.col("gap")) < F.col("gap"))
    near = ranked.join(F.broadcast(short), "number").where(near).join(taken, "row", "left_anti")
    order = F.struct("size", "rank", F.isnull("doc_id"), "doc_id", "tie", "row")
    nearest = near.groupBy("number").agg(F.min_by("row", order).alias("row"))
    return taken.union(nearest.select("row"))


def sampled(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, copies) of `docs` (row, doc_id, text, source).

    `row` numbers the rows. Copies are 0 to 3. Random numbers come from a hash
    of doc_id, so reruns agree; rows with equal ids are ordered by a hash of
    their text, then by row number. A document without words gets copies like
    the others and adds nothing. NULL sources form one source. An empty table
    gives no rows.
    """
    sized = scratch.save(
        docs.select(
            "row",
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64("text").alias("tie"),
        )
    )
    targets = with_targets(sized.select("source", "size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    targets = targets.select("*", rate.alias("rate"), F.floor(rate).cast("int").alias("certain"))
    matches = sized["source"].eqNullSafe(targets["source"])
    ranked = sized.join(F.broadcast(targets), matches).drop(targets["source"])
    # A uniform number in (0, 1) from 52 bits of the hash.
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id"), 12) + 0.5) / float(1 << 52)
    part = F.col("rate") - F.col("certain")
    buckets = F.least(F.lit(MOST_BUCKETS), F.ceil(F.col("rows") / BUCKET_ROWS))
    odds = F.when(part > 0, (uniform / (1 - uniform)) / (part / (1 - part)))
    ranked = ranked.select(
        *["row", "doc_id", "source", "size", "tie", "number", "source_size", "target", "certain"],
        odds.alias("rank"),
        # Buckets follow the ranking: rank grows with the uniform number.
        F.floor(uniform * buckets).cast("int").alias("bucket"),
    )
    missing = targets.select("number", F.col("target") - F.col("certain") * F.col("source_size"))
    extras = _extras(ranked, dict(map(tuple, missing.collect())), scratch)
    joined = ranked.join(extras.withColumn("extra", F.lit(1)), "row", "left")
    return joined.select(
        *["row", "doc_id", "source", "size", "source_size", "target"],
        (F.col("certain") + F.coalesce("extra", F.lit(0))).alias("copies"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it was sampled, with all their columns."""
    row = fresh(docs, "row")
    copies = fresh(docs, "copies")
    listed = numbered(docs, row)
    chosen = sampled(
        listed.select(F.col(row).alias("row"), "doc_id", "text", "source"),
        Scratch(docs.sparkSession, "mix"),
    )
    chosen = chosen.where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies))
    repeated = listed.join(chosen, row).withColumn(
        copies, F.explode(F.array_repeat(F.lit(0), F.col(copies)))
    )
    return repeated.select(*docs.columns)
