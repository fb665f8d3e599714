"""Ranked lexical search: impact vectors in order of length, buckets pruned by Cauchy-Schwarz, coordinate bounds inside.

A document is a vector over the terms of the queries: for each term its impact, scaled by the root of the term's weight.
A query has the same roots as its coordinates, so the inner product is the score. Each task sorts its
vectors by length, longest first, and takes them in buckets. With the 50th best score found so far as threshold, a
query is done once its length times that of a bucket's longest vector falls below it: all later vectors are shorter.
Inside a bucket the query's heaviest coordinates are multiplied out; what the others can add is bounded by the lengths
of what is left of both vectors, and by the bucket's greatest values in these coordinates. Only vectors that may still
reach the threshold are scored, exactly and in integers. Bounds are rounded up, so no document is lost.

A task returns its best documents for each query, and these are ranked, first among neighbouring tasks and then all.
Vectors are not moved between tasks. Queries are taken in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import picked, ship, written
from orderloom.llm.tokens import PLAIN_WORDS

TOP = 50
# Bytes of the queries' texts in a block, on average.
BLOCK_BYTES = 8 * 1024 * 1024
BUCKET = 4096
# Tasks whose results are ranked together before all are.
NEIGHBOURS = 128
_UP = 1.0 + 1e-9


def terms_of(text: str | None) -> list[bytes]:
    """The terms in order, A-Z lower-cased, as UTF-8."""
    return (text or "").encode(errors="replace").translate(PLAIN_WORDS).split()


@dataclass(frozen=True)
class Statistics:
    """Of the documents with a term: their number, that of their terms, and by the queries' terms the weights."""

    documents: int
    terms: int
    weights: np.ndarray

    def impacts(self, tf: np.ndarray, n: int) -> np.ndarray:
        m = 50 + (50 * n * self.documents) // self.terms
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# --- documents as vectors


def _vectors(vocabulary: dict[bytes, int]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, n, terms, tfs: numbers and occurrences of those terms that the queries have."""
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                known, counts = np.unique([k for w in words if (k := vocabulary.get(w)) is not None], return_counts=True)
                lengths.append(len(words))
                terms.append(known.astype(np.int32))
                tfs.append(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(tfs, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return read


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values, and where each row's begin and the last one's end."""
    ends = column.offsets.to_numpy()
    return column.flatten().to_numpy(), ends - ends[0]


def _weighed(shared):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, length, terms, impacts: the vectors with their lengths."""
        stats = shared.value
        roots = np.sqrt(stats.weights.astype(np.float64))
        for batch in batches:
            terms, ends = _lists(batch.column("terms"))
            tfs, _ = _lists(batch.column("tfs"))
            n = np.repeat(batch.column("n").to_numpy(), np.diff(ends))
            impacts = stats.impacts(tfs, n)
            squares = np.concatenate([np.zeros(1), np.cumsum((roots[terms] * impacts) ** 2)])
            # Differences of sums may come out a little low.
            lengths = np.sqrt(np.maximum(squares[ends[1:]] - squares[ends[:-1]] + squares[-1] * 1e-12, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths),
                    batch.column("terms"),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(impacts)),
                ],
                names=["doc_id", "length", "terms", "impacts"],
            )

    return weigh


# --- search


class Bucket:
    """Vectors, the longest first, by row and by coordinate."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray, ends: np.ndarray, roots: np.ndarray):
        self.lengths, self.terms, self.impacts, self.ends = lengths, terms, impacts, ends
        rows = np.repeat(np.arange(len(lengths)), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        self.rows, self.values = rows[order], (roots[terms] * impacts)[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(roots) + 1))
        self.greatest = np.zeros(len(roots))
        np.maximum.at(self.greatest, terms, roots[terms] * impacts)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[term], self.starts[term + 1])
        return self.rows[at], self.values[at]

    def candidates(self, query: np.ndarray, roots: np.ndarray, threshold: float) -> np.ndarray:
        """Rows that may reach the threshold. `query` has its terms, the heaviest first."""
        coordinates = roots[query]
        # What the coordinates from each place on can add to any row.
        by_value = np.append(np.cumsum((coordinates * self.greatest[query])[::-1])[::-1], 0.0)
        by_length = np.sqrt(np.append(np.cumsum((coordinates**2)[::-1])[::-1], 0.0))
        rest = np.minimum(by_value, by_length * self.lengths[0])
        focus = int(np.argmax(rest < threshold / 2)) if threshold > 0 else 0
        products, squares = np.zeros(len(self.lengths)), np.zeros(len(self.lengths))
        for term, coordinate in zip(query[:focus], coordinates[:focus], strict=True):
            rows, values = self.postings(term)
            products[rows] += coordinate * values
            squares[rows] += values * values
        left = np.sqrt(np.maximum(self.lengths**2 * _UP - squares, 0))
        bound = products + np.minimum(by_length[focus] * left, by_value[focus])
        return np.flatnonzero(bound * _UP >= threshold)

    def scores(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The rows' scores in integers; `weights` has 0 for what is no term of the query."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(self.ends[rows], sizes) + within
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(weights[self.terms[at]] * self.impacts[at])])
        stops = np.cumsum(sizes)
        return sums[stops] - sums[stops - sizes]


def _rank(entry: tuple[int, object]) -> tuple:
    """The highest score first, equal ones by id, null last."""
    return -entry[0], entry[1] is None, 0 if entry[1] is None else entry[1]


class Search:
    """The best documents of each query so far, over buckets that get shorter."""

    def __init__(self, queries: list[np.ndarray], stats: Statistics, top: int):
        self.weights, self.top = stats.weights, top
        self.roots = np.sqrt(stats.weights.astype(np.float64))
        self.queries = [q[np.argsort(-stats.weights[q], kind="stable")] for q in queries]
        self.lengths = np.array([math.sqrt(float(stats.weights[q].sum())) for q in queries])
        self.best: list[list[tuple[int, object]]] = [[] for _ in queries]
        self.thresholds = np.zeros(len(queries))
        self.verified = 0

    def take(self, bucket: Bucket, ids: pa.Array) -> None:
        longest = bucket.lengths[0]
        for q in np.flatnonzero(self.lengths * longest * _UP >= self.thresholds):
            query = self.queries[q]
            rows = bucket.candidates(query, self.roots, self.thresholds[q])
            own = np.zeros(len(self.weights), dtype=np.int64)
            own[query] = self.weights[query]
            found = bucket.scores(rows, own)
            self.verified += len(rows)
            rows, found = rows[found > 0], found[found > 0]
            if len(found) > self.top:  # with all that are equal to the last of them
                least = np.partition(found, len(found) - self.top)[len(found) - self.top]
                rows, found = rows[found >= least], found[found >= least]
            if len(found):
                new = zip(found.tolist(), ids.take(pa.array(rows)).to_pylist(), strict=True)
                self.best[q] = sorted([*self.best[q], *new], key=_rank)[: self.top]
                if len(self.best[q]) == self.top:
                    self.thresholds[q] = self.best[q][-1][0]


def _searched(shared_stats, shared_queries, top: int, bucket: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """item, doc_id, score: the best of this task's documents for each query. Rows come the longest first."""
        stats, (names, queries) = shared_stats.value, shared_queries.value
        running, schema = Search(queries, stats, top), None
        for batch in batches:
            schema = batch.schema
            for start in range(0, len(batch), bucket):
                part = batch.slice(start, bucket)
                terms, ends = _lists(part.column("terms"))
                impacts, _ = _lists(part.column("impacts"))
                lengths = part.column("length").to_numpy()
                running.take(Bucket(lengths, terms, impacts, ends, running.roots), part.column("doc_id"))
        if schema is not None:
            rows = [(names[q], i, score) for q, best in enumerate(running.best) for score, i in best]
            items, ids, scores = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(ids, schema.field("doc_id").type), pa.array(scores, pa.int64())],
                names=["item", "doc_id", "score"],
            )

    return search


def _best(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _block(docs: DataFrame, texts: list[str | None], top: int, bucket: int) -> DataFrame:
    """item (the text's number), rank, doc_id, score."""
    context = docs.sparkSession.sparkContext
    words = [set(terms_of(t)) for t in texts]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*words)))}
    id_type = docs.schema["doc_id"].dataType.simpleString()
    vectors = written(
        docs.mapInArrow(_vectors(vocabulary), f"doc_id {id_type}, n long, terms array<int>, tfs array<long>"), "vectors"
    )
    total = vectors.where("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).head()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for row in held.collect():  # at most as many rows as the block has terms
        df[row["term"]] = row["df"]
    weights = np.array([weight(total["n"], int(x)) for x in df], dtype=np.int64)
    stats = context.broadcast(Statistics(total["n"], total["terms"] or 1, weights))
    queries = [np.array(sorted(vocabulary[w] for w in own), dtype=np.int64) for own in words]
    asked = [i for i, q in enumerate(queries) if len(q)]
    shared = context.broadcast((asked, [queries[i] for i in asked]))
    weighed = vectors.where(F.size("terms") > 0).mapInArrow(
        _weighed(stats), f"doc_id {id_type}, length double, terms array<int>, impacts array<long>"
    )
    found = weighed.sortWithinPartitions(F.desc("length")).mapInArrow(
        _searched(stats, shared, top, bucket), f"item long, doc_id {id_type}, score long"
    )
    near = found.withColumn("_near", F.floor(F.spark_partition_id() / NEIGHBOURS))
    return _best(_best(near, ["item", "_near"], top), ["item"], top).select("item", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    bucket: int = BUCKET,
) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the `top` documents with the highest scores above 0.

    Equal scores are in order of doc_id, null last. Each row of `docs` is a document, also where rows repeat an id or have
    none; rows of `items` that agree in id and text are one item, and rows with the same id and other texts are ranked
    each by itself. A null text has no terms; an item without terms, or without documents that have any of
    them, gives no row. Further columns are left alone. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = picked(docs, doc_id=id_col, text=text_col)
    asked = picked(items, item_id=item_col, text=item_text_col).distinct()
    asked = written(asked.withColumn("_size", F.coalesce(F.octet_length("text"), F.lit(0)) + 64), "items")
    blocks = math.ceil((asked.agg(F.sum("_size")).head()[0] or 0) / block_bytes)
    item_type = asked.schema["item_id"].dataType.simpleString()
    id_type = plain.schema["doc_id"].dataType.simpleString()
    found = [spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")]
    for k in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {item_type}")
        block = _block(plain, [r["text"] for r in rows], top, bucket).join(F.broadcast(names), "item")
        found.append(written(block.select("item_id", "rank", "doc_id", "score"), "ranked"))
    return reduce(DataFrame.unionAll, found[1:] or found)
