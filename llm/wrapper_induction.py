"""Main text of web pages by wrapper induction (operator 13).

Pages become folded trees of block elements (`markup`). The trees of a host's
pages are aligned by simple tree matching into one template that holds them all,
and every text of a page is a value of the template's node it aligns with. A
node's text that nearly all differing pages with that node share is template; what
varies is a slot, and slots that are menus, adverts and the like by their
element, role or name, or by consisting of links, hold no main text. Where a
page marks its article or main part, only slots within it count.

Shapes (trees without texts) are counted per host first, and only the distinct
ones are aligned: in blocks of a host's shapes, then the blocks' templates. No
task sees all pages of a host. The host's texts are counted by hash in a shuffle
with partial aggregation, however many pages share one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import markup
from llm.common import Scratch, append_columns, fresh, slices

# Parts in which a host's shapes are aligned before these are aligned with one another.
PARTS = 64
# A text is constant if this share of the differing pages with its node, so many at least, has it.
CONSTANT_SHARE = 0.9
LEAST_VARIANTS = 5
# A slot outside any main part is a menu if links make up this share of its text.
LINK_SHARE = 0.5

HOST = re.compile(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)", re.I)

BLOCK = T.StructType(
    [
        T.StructField("node", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("links", T.IntegerType()),
        T.StructField("main", T.BooleanType()),
    ]
)


def host_of(url: str | None) -> str | None:
    """The host of an address with a scheme, in lower case."""
    found = HOST.match(url.strip()) if url else None
    return found[1].lower() if found else None


def parsed(pages: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """`pages` (url, html, ...) with the host, the shape and the blocks under these names."""
    kinds = [T.StringType(), T.StringType(), T.ArrayType(BLOCK)]
    fields = [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]

    def factory():
        def parse(urls, htmls):
            found = [markup.Page(h or "") for h in htmls]
            blocks = [[b._asdict() for b in p.blocks] for p in found]
            return [host_of(u) for u in urls], [p.shape for p in found], blocks

        return parse

    return append_columns(pages, ["url", "html"], fields, factory)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One template for each run of rows (host, part, shape) with the same host and part."""

    def rows():
        for batch in batches:
            yield from zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)

    for (host, part), own in groupby(rows(), key=lambda r: r[:2]):
        template = None
        for *_, shape in own:
            tree = markup.from_shape(shape)
            template = tree if template is None else markup.merge(template, tree)
        columns = [pa.array([v], k) for v, k in ((host, pa.string()), (part, pa.int64()))]
        columns.append(pa.array([template.shape()]))
        yield pa.RecordBatch.from_arrays(columns, names=["host", "part", "shape"])


def templates(shapes: DataFrame) -> DataFrame:
    """(host, shape) of the template of each host, from its distinct shapes (host, shape, pages).

    Frequent shapes are aligned first. The result depends on the shapes alone,
    not on how they are partitioned.
    """
    schema = "host string, part long, shape string"
    part = F.pmod(F.xxhash64("shape"), F.lit(PARTS)).alias("part")
    first = shapes.select("host", part, "shape", "pages").repartition("host", "part")
    first = first.sortWithinPartitions("host", "part", F.desc("pages"), "shape")
    parts = first.select("host", "part", "shape").mapInArrow(_folded, schema)
    second = parts.repartition("host").sortWithinPartitions("host", "part")
    whole = second.select("host", F.lit(0).cast("long").alias("part"), "shape")
    return whole.mapInArrow(_folded, schema).select("host", "shape")


def _alignments(shapes: DataFrame, found: DataFrame) -> DataFrame:
    """(host, shape, places): the template's node of each node of each shape of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, template = None, None
        for part in slices(batches):
            hosts, own, theirs = (part.column(i) for i in range(3))
            places = []
            for h, s, t in zip(hosts.to_pylist(), own.to_pylist(), theirs.to_pylist(), strict=True):
                if template is None or h != host:
                    host, template = h, markup.from_shape(t)
                    template.enumerate()
                places.append(markup.aligned(template, markup.from_shape(s)))
            yield pa.RecordBatch.from_arrays(
                [hosts, own, pa.array(places, pa.list_(pa.int32()))],
                names=["host", "shape", "places"],
            )

    both = shapes.select("host", "shape").join(found.withColumnRenamed("shape", "template"), "host")
    return both.mapInArrow(run, "host string, shape string, places array<int>")


def _texts(blocks: Column) -> Column:
    return F.transform(blocks, lambda b: b["text"])


def _main(blocks: Column) -> Column:
    """The blocks within a marked article or main part, all if none is marked."""
    inside = F.filter(blocks, lambda b: b["main"])
    return F.when(F.size(inside) > 0, inside).otherwise(blocks)


def _not_content(pages: DataFrame, placed: DataFrame) -> DataFrame:
    """(host, constants, menus): constant texts by node and hash, and nodes that are menus."""
    seen = pages.join(placed, ["host", "shape"]).select(
        "host",
        "places",
        "blocks",
        F.xxhash64(_texts(_main(F.col("blocks")))).alias("variant"),
    )
    seen = seen.select("host", "places", "variant", F.explode("blocks").alias("b")).select(
        "host",
        F.get("places", F.col("b.node")).alias("node"),
        F.xxhash64("b.text").alias("text"),
        "variant",
        *["b.main", "b.links"],
        F.length("b.text").alias("chars"),
    )
    texts = seen.groupBy("host", "node", "text", "variant").agg(
        F.sum("links").alias("links"),
        F.sum("chars").alias("chars"),
        F.max("main").alias("main"),
    )
    per_text = texts.groupBy("host", "node", "text").agg(
        F.count("*").alias("variants"),
        F.sum("links").alias("links"),
        F.sum("chars").alias("chars"),
        F.max("main").alias("main"),
    )
    at_node = texts.select("host", "node", "variant").distinct()
    at_node = at_node.groupBy("host", "node").agg(F.count("*").alias("all_variants"))
    constants = per_text.where(F.col("variants") >= LEAST_VARIANTS).join(at_node, ["host", "node"])
    constants = constants.where(F.col("variants") >= F.col("all_variants") * CONSTANT_SHARE)
    constants = constants.groupBy("host").agg(
        F.collect_list(F.struct("node", "text")).alias("constants")
    )
    menus = per_text.groupBy("host", "node").agg(
        F.sum("links").alias("links"), F.sum("chars").alias("chars"), F.max("main").alias("main")
    )
    menus = menus.where(~F.col("main") & (F.col("links") >= F.col("chars") * LINK_SHARE))
    menus = menus.groupBy("host").agg(F.collect_list("node").alias("menus"))
    return constants.join(menus, "host", "full")


def extracted(pages: DataFrame, text: str = "text", label: str = "wrappers") -> DataFrame:
    """`pages` (url, html, ...) without html, with the main text of each page under `text`.

    White space within a block is one space; blocks follow in page order, joined
    by a space. A NULL or empty html, and a page that is all template, has the
    empty text. Pages whose url is NULL or names no host are aligned with no
    other: nothing in them is known to be constant. Repeated pages are pages of
    their own but no evidence of a constant text, for which pages must differ.
    Elements below the 100th level belong to their ancestor there. An empty
    table gives an empty one. Columns that have the name `text` are replaced.
    """
    scratch = Scratch(pages.sparkSession, label)
    kept = [c for c in pages.columns if c not in ("html", text)]
    hosts, shape, blocks = (fresh(pages, n) for n in ("host", "shape", "blocks"))
    read = parsed(pages, (hosts, shape, blocks))
    read = scratch.save(read.select(*kept, hosts, shape, blocks))
    own = read.select(
        F.col(hosts).alias("host"), F.col(shape).alias("shape"), F.col(blocks).alias("blocks")
    ).where("host is not null")
    shapes = scratch.save(own.groupBy("host", "shape").agg(F.count("*").alias("pages")))
    placed = scratch.save(_alignments(shapes, templates(shapes)))
    facts = scratch.save(_not_content(own, placed))
    scratch.drop(shapes)
    at, constants, menus = (fresh(read, n) for n in ("places", "constants", "menus"))
    # Written, so that Spark knows its size: a small one goes to all tasks, and the
    # pages, a third of which may have one host and shape, move only beside a large one.
    known = scratch.save(placed.join(facts, "host", "left"))
    scratch.drop(placed)
    scratch.drop(facts)
    known = known.toDF(hosts, shape, at, constants, menus)
    none = F.array().cast("array<struct<node:int,text:bigint>>")

    def is_content(b: Column) -> Column:
        node = F.get(F.col(at), b["node"])
        constant = F.array_contains(
            F.coalesce(F.col(constants), none),
            F.struct(node.alias("node"), F.xxhash64(b["text"]).alias("text")),
        )
        menu = F.array_contains(F.coalesce(F.col(menus), F.array().cast("array<int>")), node)
        return ~F.coalesce(constant, F.lit(False)) & ~F.coalesce(menu, F.lit(False))

    found = read.join(known, [hosts, shape], "left")
    content = _main(F.filter(F.col(blocks), is_content))
    return found.select(*kept, F.array_join(_texts(content), " ").alias(text))
