"""Benchmark passages in training text, by a broadcast hash set of test n-grams.

Items become windows of 13 normalised words (an item of fewer is one window). Their hashes fill a bitmap
of a fixed number of bits, which goes along with the scan: at each word of a document, five words of the
window that starts there are hashed and looked up, within the row that holds the text. What the
bitmap lets through is joined with the windows themselves, word for word, which verifies it. The
windows are broadcast up to a checked size and joined by a shuffle beyond. The bitmap's size never
changes: more items let more windows through to the join, and none is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import bitmaps
from orderloom.llm.common import SEPARATORS, boxed, picked, unboxed, words_of, written

WINDOW = 13
EVERY_NTH = 3
BROADCAST_BYTES = 32 * 1024 * 1024
# A document counts as contaminated where one word in so many is hit.
ONE_IN = 20


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """gram, length, items: each distinct window with the ids of the items that have it, as texts."""
    items = picked(benchmark, item_id="item_id", text="text")
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    return (
        words.withColumn("length", length)
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)))
        .select(F.expr("array_join(slice(words, start, length), ' ')").alias("gram"), "length", "item_id")
        .groupBy("gram", "length")
        .agg(F.collect_set("item_id").alias("items"))
    )


def _bit(words: Column, start: Column, length: int, bits: int) -> Column:
    """The bit of the window that begins at `start`: a hash of every third word and the last."""
    places = sorted({*range(0, length, EVERY_NTH), length - 1})
    return bitmaps.bit_of(*[words[(start + k).cast("int")] for k in places], bits=bits)


def _windows_let_through(grams: DataFrame, length: int, bits: int) -> Column:
    """The windows of one length whose bit is set. A start and its bit travel as one number."""
    own = grams.where(F.col("length") == length).select(F.split("gram", " ").alias("words"))
    table = bitmaps.constant(bitmaps.gathered(own, _bit(F.col("words"), F.lit(0), length, bits), bits))
    shift = bits.bit_length() - 1
    starts = F.sequence(F.lit(0).cast("bigint"), F.size("words").cast("bigint") - length)
    probed = F.transform(
        starts,
        lambda i: F.shiftleft(i, shift).bitwiseOR(_bit(F.col("words"), i, length, bits)),
    )
    passed = F.filter(probed, lambda v: bitmaps.holds(table, v.bitwiseAND(F.lit(bits - 1))))
    return F.when(
        F.size("words") >= length,
        F.transform(
            passed,
            lambda v: F.struct(
                F.shiftright(v, shift).cast("int").alias("start"),
                F.lit(length).alias("length"),
                F.concat_ws(
                    " ", *[F.col("words")[(F.shiftright(v, shift) + k).cast("int")] for k in range(length)]
                ).alias("gram"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<start:int,length:int,gram:string>>"))


def scanned(docs: DataFrame, grams: DataFrame, id_col: str, text_col: str, bits: int = bitmaps.BITS) -> DataFrame:
    """One row per document, written: row, doc_id, text_key, n_words and the windows let through."""
    lengths = sorted(r["length"] for r in grams.select("length").distinct().collect())
    found = [_windows_let_through(grams, n, bits) for n in lengths]
    none = F.array().cast("array<struct<start:int,length:int,gram:string>>")
    words = picked(docs, doc_id=id_col, text=text_col).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("text", 256).alias("text_key"),
        words_of(F.col("text")).alias("words"),
    )
    return written(
        words.select(
            "row",
            "doc_id",
            "text_key",
            F.size("words").cast("bigint").alias("n_words"),
            (F.concat(*found) if found else none).alias("found"),
        ),
        "windows",
    )


def covered_words(spans: Column) -> Column:
    """How many words the spans (start, end) cover together."""
    state = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        F.array_sort(spans),
        state,
        lambda acc, x: F.struct(
            F.greatest(acc["upto"], x["end"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(acc["upto"], x["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, n_items, items, spans, contaminated.

    `items` are the ids of the items with a window in the document, sorted as texts, and `spans` the
    places of the windows in words. A null or empty text has no words; an item without words has no
    window; without items nothing is hit. Every row is judged by itself, also rows with a repeated or
    null id. `text_key` is the SHA-256 of the text as it is, null for null.
    """
    grams = written(item_windows(benchmark, window), "grams")
    size = grams.agg(F.sum(F.length("gram") + 64 + 24 * F.size("items"))).head()[0] or 0
    base = scanned(docs, grams, id_col, text_col)
    known = grams.select("gram", "items")
    hits = (
        base.select("row", F.inline("found"))
        .join(F.broadcast(known) if size <= broadcast_bytes else known, "gram")
        .groupBy("row")
        .agg(
            F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    no_spans, no_items = F.array().cast("array<struct<start:int,end:int>>"), F.array().cast("array<string>")
    hit = F.coalesce(covered_words(F.col("spans")), F.lit(0)).cast("bigint")
    return (
        base.select("row", "doc_id", "text_key", "n_words")
        .join(hits, "row", "left")
        .select(
            "doc_id",
            "text_key",
            "n_words",
            hit.alias("n_hit"),
            F.coalesce("items", no_items).alias("items"),
            F.coalesce("spans", no_spans).alias("spans"),
        )
        .select(
            "*",
            F.size("items").cast("bigint").alias("n_items"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that aren't contaminated, as they are."""
    bad = contamination(docs, benchmark, id_col, text_col).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("bad_id"), "text_key").distinct()
    rows = boxed(docs, doc_id=id_col, text=text_col).select("row", "doc_id", F.sha2("text", 256).alias("own"))
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & F.col("own").eqNullSafe(F.col("text_key"))
    return unboxed(rows.join(bad, same, "left_anti"), docs)


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and the separators before them."""
    kept = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(kept, SEPARATORS), lambda w: w != "")
    between = F.split(kept, r"[0-9A-Za-z\x{80}-\x{10FFFF}]+", -1)
    pieces = F.transform(
        words,
        lambda w, i: F.when(
            F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"])), F.lit("")
        ).otherwise(F.concat(between[i], w)),
    )
    return F.concat(F.array_join(pieces, ""), F.element_at(between, -1))

