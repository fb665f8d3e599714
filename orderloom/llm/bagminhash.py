"""Near duplicates by weighted Jaccard similarity of word shingles: BagMinHash, bands, exact overlap.

A text is a bag: each run of five words with the number of times it occurs. Each shingle d carries a Poisson
process of points over (time, level): level l is there from weight l on, points fall on random places of
the signature, and a place keeps its earliest point. Two bags agree in a place with the probability of
their weighted Jaccard similarity, as the earliest point of the larger bag lies in the smaller one with just
that chance. Levels are the whole weights and come in a hierarchy of blocks, 1, 2, 3-4, 5-8, ..., each
with one process of the block's rate whose points are thinned out to the levels a weight reaches, so
a weight costs its logarithm. Points are made in order of time and only up to the time by which all places
are taken, so a long text costs little more than a pass over its shingles.

Texts that are equal stand for one node. Nodes that share a band of the signature share a bucket. Emitting all
pairs of a bucket would be quadratic, so a bucket links its members to one of them, its pivot: those pairs are
verified by the exact overlap of the shingles' words, and components of the links are formed. A bucket is settled if
its other members lie in one component. The members of those that aren't are cut into blocks of bounded size, and two blocks at a
time meet in a task, which works out the overlaps of all their texts as a product of matrices and returns the
links that join components, a spanning forest at most. No candidate pair is skipped: each is verified, or
has both ends in one component already.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from orderloom.llm.common import boxed, picked, ship, small_enough, unboxed, written
from orderloom.llm.components import components
from orderloom.llm.tokens import PLAIN_WORDS, mixed, shingles, word_hashes, word_runs

SHINGLE = 5
SIMILAR = 0.8
ROWS, BANDS = 5, 28
# A block's texts and shingles, on average; two blocks meet in a task.
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 1 << 18
SLICE = 1 << 13
BROADCAST_BYTES = 32 * 1024 * 1024

_SCALE = 2.0**-53
_GOLDEN = 0x9E3779B97F4A7C15


def bag(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles, in order, and their weights."""
    return np.unique(shingles(word_hashes(text, PLAIN_WORDS), size), return_counts=True)


def _unit(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * _SCALE


def _block(sig: np.ndarray, items: np.ndarray, weights: np.ndarray, block: int, until: float) -> None:
    """Take the points of one block of levels up to a time into the signature."""
    low = 0 if block == 0 else 1 << (block - 1)
    levels = 1 if block == 0 else 1 << (block - 1)
    reach = np.minimum(weights - low, levels)
    seeds = mixed(items + np.uint64((block + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF))
    times = np.zeros(len(seeds))
    step, i = max(1, min(64, int(until * levels / 2))), 0
    while len(seeds):
        number = np.arange(i, i + step, dtype=np.uint64)[None, :] * np.uint64(3)
        draw = seeds[:, None] + number * np.uint64(_GOLDEN)
        at = times[:, None] + np.cumsum(-np.log(_unit(mixed(draw))) / levels, axis=1)
        taken = at <= until
        if levels > 1:
            level = _unit(mixed(draw + np.uint64(_GOLDEN))) * levels
            taken &= level <= reach[:, None]
        place = mixed(draw + np.uint64(2 * _GOLDEN & 0xFFFFFFFFFFFFFFFF)) % np.uint64(len(sig))
        np.minimum.at(sig, place[taken].astype(np.int64), at[taken])
        going = at[:, -1] <= until
        seeds, times, reach = seeds[going], at[going, -1], reach[going]
        i += step


def signature(items: np.ndarray, weights: np.ndarray, places: int = ROWS * BANDS) -> np.ndarray:
    """The earliest time at each place; equal times are the same point."""
    sig = np.full(places, np.inf)
    if not len(items):
        return sig
    until = places * (np.log(places) + 7.0) / float(weights.sum())
    while True:
        sig[:] = np.inf
        block = 0
        while True:
            low = 0 if block == 0 else 1 << (block - 1)
            within = weights > low
            if not within.any():
                break
            _block(sig, items[within], weights[within], block, until)
            block += 1
        if np.isfinite(sig).all():
            return sig
        until *= 2


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One number per band, different bands apart."""
    points = sig.view(np.uint64).reshape(-1, rows)
    key = np.arange(1, len(points) + 1, dtype=np.uint64)
    for k in range(rows):
        key = mixed(key * np.uint64(_GOLDEN) + points[:, k])
    return key.view(np.int64)


def exact_bag(text: str | None, size: int = SHINGLE) -> Counter[bytes]:
    """The shingles themselves and their weights."""
    return Counter(word_runs(text, PLAIN_WORDS, size))


def similarity(a: Counter[bytes], b: Counter[bytes]) -> float:
    """Weighted Jaccard similarity of two bags; 0 if either is empty."""
    if not a or not b:
        return 0.0
    if len(b) < len(a):
        a, b = b, a
    shared = sum(min(w, b[x]) for x, w in a.items() if x in b)
    return shared / (a.total() + b.total() - shared)


def _node(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, ends = [], [], [0]
        for text in batch.column("text"):
            items, weights = bag(text.as_py())
            bands = band_keys(signature(items, weights)) if len(items) else np.zeros(0, dtype=np.int64)
            sizes.append(int(weights.sum()) if len(items) else 0)
            keys.append(bands)
            ends.append(ends[-1] + len(bands))
        values = pa.array(np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64))
        bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("node"), pa.array(sizes, pa.int64()), bands],
            names=["doc_id", "node", "size", "bands"],
        )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = lru_cache(maxsize=16)(exact_bag)
    for batch in batches:
        pairs = zip(batch.column("a_text"), batch.column("b_text"), strict=True)
        found = [similarity(read(a.as_py()), exact_bag(b.as_py())) for a, b in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"]
        )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity: the pairs with their exact similarity, written. Pairs are dealt out by `b` for its text, then
    by `a`: each side of either join has a row per text or pair, so a text with very many pairs may be split."""
    a_texts = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    b_texts = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    rows = pairs.select("a", "b").join(b_texts, "b").join(a_texts, "a").select("a", "b", "a_text", "b_text")
    schema = rows.select("a", "b").schema.add("similarity", "double")
    return written(rows.mapInArrow(_compared, schema), "verified")


def _starred(members: DataFrame, similar: float) -> DataFrame:
    """Pairs of each bucket's pivot, its least node, and those members that may be as similar by their sizes."""
    pivots = members.groupBy("bucket").agg(F.min(F.struct("node", "size")).alias("pivot"))
    # Written, both sides of the join are plain tables, and Spark may split a bucket with very many members.
    pivots = written(pivots.select("bucket", F.col("pivot.node").alias("a"), F.col("pivot.size").alias("a_size")), "pivots")
    sides = members.select("bucket", F.col("node").alias("b"), F.col("size").alias("b_size"))
    plausible = F.least("a_size", "b_size") >= similar * F.greatest("a_size", "b_size")
    return sides.join(pivots, "bucket").where((F.col("a") != F.col("b")) & plausible).select("a", "b").distinct()


def _unsettled(members: DataFrame, links: DataFrame) -> DataFrame:
    """bucket, node, component, block, blocks: the members, without pivots, of buckets where they lie in more than one
    component, dealt to blocks of bounded size."""
    placed = members.join(components(links), "node", "left").select(
        "bucket", "node", "size", F.coalesce("component", "node").alias("component")
    )
    placed = written(placed, "placed-members")
    spans = written(placed.groupBy("bucket").agg(F.min("node").alias("pivot")), "spans")
    others = placed.join(spans, "bucket").where(F.col("node") != F.col("pivot")).drop("pivot")
    others = written(others, "members")
    sizes = others.groupBy("bucket").agg(
        F.min("component").alias("x"),
        F.max("component").alias("y"),
        F.greatest(
            F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_TEXTS)), F.ceil(F.sum("size") / F.lit(BLOCK_SHINGLES))
        ).alias("blocks"),
    )
    open_buckets = written(sizes.where("x <> y").select("bucket", "blocks"), "open-buckets")
    return others.join(open_buckets, "bucket").select(
        "bucket", "node", "component", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), "blocks"
    )


def _overlaps(bags: list[Counter[bytes]]) -> np.ndarray:
    """Weighted overlap of each two bags. A shingle of weight w counts as w elements, of which two bags share the
    smaller number; elements of one bag only are left out, the others go through in slices. Shingles are numbered as
    they come, so different ones are told apart."""
    numbers: dict[bytes, int] = {}
    items = [np.array([numbers.setdefault(x, len(numbers)) for x in b], dtype=np.uint64) for b in bags]
    weights = [np.fromiter(b.values(), dtype=np.int64, count=len(b)) for b in bags]
    owner = np.repeat(np.arange(len(bags)), [int(w.sum()) for w in weights])
    ranks = np.concatenate([_ranks(w) for w in weights])
    # The rank counts in steps of the number of shingles, so an element is a number of its own.
    elements = np.concatenate([np.repeat(x, w) for x, w in zip(items, weights, strict=True)])
    elements = elements + ranks * np.uint64(len(numbers))
    _, column, count = np.unique(elements, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    kept = shared[column]
    owner, column = owner[kept], number[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(bags), len(bags)), dtype=np.float64)
    for start in range(0, int(shared.sum()), SLICE):
        low, high = np.searchsorted(column, [start, start + SLICE])
        part = np.zeros((len(bags), SLICE), dtype=np.float32)
        part[owner[low:high], column[low:high] - start] = 1.0
        out += part @ part.T
    return out


def _ranks(weights: np.ndarray) -> np.ndarray:
    """0, 1, ... w - 1 for each weight."""
    ends = np.cumsum(weights)
    return (np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - weights, weights)).astype(np.uint64)


def _forest(similar: float):
    def join(block: pd.DataFrame) -> pd.DataFrame:
        """Links of `similar` or more between components, from both of two blocks or within one."""
        two = block["block"].nunique() > 1
        bags = [exact_bag(t) for t in block["text"]]
        sizes = np.array([float(b.total()) for b in bags])
        shared = _overlaps(bags)
        score = shared / (sizes[:, None] + sizes[None, :] - shared)
        parts = block["component"].to_numpy()
        number = np.unique([bytes(p) for p in parts], return_inverse=True)[1]
        linked = np.triu(score >= similar, 1) & (number[:, None] != number[None, :])
        if two:
            blocks = block["block"].to_numpy()
            linked &= blocks[:, None] != blocks[None, :]
        root = np.arange(number.max() + 1)
        found = []
        for i, j in zip(*np.nonzero(linked), strict=True):
            x, y = root[number[i]], root[number[j]]
            if x != y:
                root[root == y] = x
                found.append((i, j))
        nodes = block["node"].to_numpy()
        return pd.DataFrame(
            [(nodes[i], nodes[j], score[i, j]) for i, j in found], columns=["a", "b", "similarity"]
        )

    return join


def similar_links(nodes: DataFrame, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """a, b, similarity: verified links, whose components are those of all candidate pairs that are similar. `nodes`
    has node, size, bands; `docs` has doc_id and text."""
    opened = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = opened.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = written(opened.join(shared, "bucket"), "buckets")
    wanted = written(members.select("node").distinct(), "candidates")
    texts = docs.select(_node(F.col("text")).alias("node"), "text").join(
        small_enough(wanted, 64, BROADCAST_BYTES), "node", "left_semi"
    )
    texts = written(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")

    links = _verified(_starred(members, similar), texts).where(F.col("similarity") >= similar)
    open_members = written(_unsettled(members, links), "unsettled")
    if open_members.isEmpty():
        return links
    block, other = F.col("block"), F.col("other")
    dealt = (
        open_members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            "bucket", F.least(block, other).alias("low"), F.greatest(block, other).alias("high"), "block", "node", "component"
        )
        .join(texts, "node")
    )
    schema = links.select("a", "b", "similarity").schema
    joined = dealt.groupBy("bucket", "low", "high").applyInPandas(_forest(similar), schema)
    return links.union(written(joined, "joined"))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR
) -> DataFrame:
    """One row per document: doc_id, node, class_id, class_size, kept.

    A class is a connected component of texts whose five-word shingles have a weighted Jaccard similarity of
    `similar` or more; equal texts are always in one class. Words are lower-cased runs of letters and
    digits; a text of fewer than five words is one shingle. A text without words is similar to equal
    texts only; null counts as empty. `class_id` is the smallest id of the class, and its document is kept;
    rows repeated with id and text are the same document, and a class of null ids alone is kept whole. An empty
    table gives an empty result.
    """
    ship(docs.sparkSession)
    plain = picked(docs, doc_id=id_col, text=text_col)
    signed = plain.select("doc_id", _node(F.col("text")).alias("node"), "text")
    schema = signed.select("doc_id", "node").schema.add("size", "long").add("bands", ArrayType(LongType()))
    base = written(signed.mapInArrow(_signed, schema), "signatures")
    nodes = written(
        base.groupBy("node").agg(
            F.min("doc_id").alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.first("size").alias("size"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    links = written(similar_links(nodes, plain, similar), "similar")
    placed = nodes.join(components(links), "node", "left").select(
        "node", "least", "copies", F.coalesce("component", "node").alias("component")
    )
    placed = written(placed, "placed")
    classes = placed.groupBy("component").agg(
        F.min("least").alias("class_id"), F.sum("copies").alias("class_size")
    )
    of_node = written(placed.join(classes, "component").select("node", "class_id", "class_size"), "classes")
    return (
        base.select("doc_id", "node")
        .join(of_node, "node")
        .select(
            "doc_id", "node", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
        )
    )


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, as they are."""
    gone = near_groups(docs, id_col, text_col).where(~F.col("kept")).select(
        F.col("doc_id").alias("gone_id"), "node"
    )
    gone = small_enough(written(gone.distinct(), "gone"), 96, BROADCAST_BYTES)
    rows = boxed(docs, doc_id=id_col, text=text_col).select("row", "doc_id", _node(F.col("text")).alias("own"))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("own") == F.col("node"))
    return unboxed(rows.join(gone, same, "left_anti"), docs)
