"""Repeated passages by recompression of the texts' words.

Recompression shortens a sequence in rounds that name runs (a symbol repeated) and pairs: a hash deals the
symbols into left and right ones, and each left symbol followed by a right one becomes one new symbol. Names are
hashes of what they stand for, so all tasks give equal pieces equal names without a common dictionary. What
becomes of a piece depends on the piece itself but for its edges, where a run may go on or a symbol may
pair with one outside. A window of words therefore has a core at each level, the symbols that are sure
to be formed inside it whatever stands around it: naming runs gives up the first and the last run, naming pairs a
leading right and a trailing left symbol. Equal windows have equal cores.

The anchor of a window is the least, by hash, of the `GRAM` successive symbols of its core, at the highest level
whose core has as many. Equal windows have equal anchors at the same place, so a window whose anchor stands at
one place of the corpus only isn't repeated. Neighbouring windows share anchors, which makes them about ten
times fewer than words, and only those are counted across the corpus, after each task has added up its
own. Words have 64-bit numbers up to here, which different words may share: that can only make an anchor found again that
is not. Windows with such an anchor are verified by their words: 128 bits of the SHA-256 of a window's bytes are
counted, and those that occur at least twice are the repeats.

Texts that are equal to the byte are represented by one of them; each of their windows is repeated. The anchors found
again go to the scan as a sorted array if they are measured to be few, and by a join beyond that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import picked, ship, small_enough, written
from orderloom.llm.tokens import RAW_WORDS, mixed, word_hashes

WINDOW = 35
LEVELS = 3
# Runs are named in each so many rounds; they are rare, and naming them costs each core two symbols.
RUNS_EVERY = 4
GRAM = 5
CHUNK_WORDS = 1 << 17
BROADCAST_BYTES = 32 * 1024 * 1024

_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPAN = CHUNK_WORDS + WINDOW


@dataclass
class Chunk:
    """Words of one or more texts, one after the other, and the windows that lie within a text."""

    words: np.ndarray
    starts: np.ndarray  # of windows
    text: np.ndarray  # by window: the number of its text
    place: np.ndarray  # by window: its start in the text


def chunks(texts: Iterable[np.ndarray], window: int = WINDOW) -> Iterator[Chunk]:
    """Bounded chunks. A long text is cut so that each of its windows lies in one piece."""
    pieces: list[tuple[int, int, np.ndarray]] = []
    held = 0

    def chunk() -> Chunk:
        words = np.concatenate([w for *_, w in pieces])
        counts = np.array([len(w) - window + 1 for *_, w in pieces])
        ends = np.cumsum([len(w) for *_, w in pieces])
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return Chunk(
            words,
            within + np.repeat(ends - counts - window + 1, counts),
            np.repeat([i for i, *_ in pieces], counts),
            within + np.repeat([start for _, start, _ in pieces], counts),
        )

    for i, words in enumerate(texts):
        for start in range(0, max(len(words) - window + 1, 0), CHUNK_WORDS):
            piece = words[start : start + CHUNK_WORDS + window - 1]
            if held + len(piece) > _SPAN and pieces:
                yield chunk()
                pieces, held = [], 0
            pieces.append((i, start, piece))
            held += len(piece)
    if pieces:
        yield chunk()


def _name_runs(symbols, first, end):
    """Symbols with runs named; cores without their first and last run."""
    starts = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    lengths = np.diff(np.append(starts, len(symbols))).astype(np.uint64)
    run_of = np.repeat(np.arange(len(starts)), lengths.astype(np.int64))
    heads = symbols[starts]
    named = np.where(lengths > 1, mixed(heads * _STEP + lengths), heads)
    return named, run_of[first] + 1, run_of[end - 1]


def _name_pairs(symbols, first, end, level):
    """Symbols with pairs named; cores without a leading right and a trailing left symbol."""
    right = (mixed(symbols + np.uint64(level * 2 + 1)) & np.uint64(1)).astype(bool)
    opens = np.concatenate([~right[:-1] & right[1:], [False]])
    keeps = np.concatenate([[True], ~opens[:-1]])
    follower = np.append(symbols[1:], np.uint64(0))
    named = np.where(opens, mixed(symbols * _STEP + follower + np.uint64(level + 1)), symbols)[keeps]
    place = np.cumsum(keeps) - 1
    first = first + right[first]
    end = end - ~right[end - 1]
    inside = first < end
    return named, np.where(inside, place[np.minimum(first, len(place) - 1)], 0), np.where(inside, place[end - 1] + 1, 0)


def _least_gram(symbols, first, end, level):
    """Key and place of the least gram within each core; cores have a gram at least."""
    n = len(symbols) - GRAM + 1
    keys = np.full(n, level + 1, dtype=np.uint64)
    for k in range(GRAM):
        keys = keys * _STEP + symbols[k : k + n]
    keys = mixed(keys)
    tables = [np.arange(n)]
    span = 1
    while 2 * span <= int((end - first).max()) - GRAM + 1:
        low = tables[-1]
        ahead = np.minimum(np.arange(n) + span, n - 1)
        tables.append(np.where(keys[low[ahead]] < keys[low], low[ahead], low))
        span *= 2
    stacked = np.stack(tables)
    size = end - first - GRAM + 1
    depth = np.frexp(size)[1] - 1
    one = stacked[depth, first]
    two = stacked[depth, first + size - (1 << depth)]
    least = np.where(keys[two] < keys[one], two, one)
    return keys[least], least


def anchors(chunk: Chunk, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """By window: the key of its anchor, and a number that tells the places of anchors in the chunk apart."""
    first, end = chunk.starts, chunk.starts + window
    symbols = chunk.words
    levels = [(symbols, first, end)]
    for level in range(LEVELS):
        live = end > first
        safe_first, safe_end = np.where(live, first, 0), np.where(live, end, 1)
        if level % RUNS_EVERY == 0:
            symbols, first, end = _name_runs(symbols, safe_first, safe_end)
            live &= end > first
            safe_first, safe_end = np.where(live, first, 0), np.where(live, end, 1)
        symbols, first, end = _name_pairs(symbols, safe_first, safe_end, level)
        first, end = np.where(live, first, 0), np.where(live, end, 0)
        levels.append((symbols, first, end))
    keys = np.zeros(len(chunk.starts), dtype=np.uint64)
    places = np.zeros(len(chunk.starts), dtype=np.int64)
    open_windows = np.ones(len(chunk.starts), dtype=bool)
    for level in range(LEVELS, -1, -1):
        symbols, first, end = levels[level]
        here = np.flatnonzero(open_windows & (end - first >= GRAM))
        if len(here):
            key, place = _least_gram(symbols, first[here], end[here], level)
            keys[here], places[here] = key, place * (LEVELS + 1) + level
            open_windows[here] = False
    return keys, places


class Words:
    """The words of a text, joined by a space, and where they begin and end."""

    def __init__(self, text: str | None):
        self.data = b" ".join((text or "").encode(errors="replace").translate(RAW_WORDS).split())
        spaces = np.flatnonzero(np.frombuffer(self.data, dtype=np.uint8) == 0x20)
        self.starts = np.concatenate([[0], spaces + 1])
        self.ends = np.concatenate([spaces, [len(self.data)]])

    def digests(self, places: np.ndarray, window: int) -> np.ndarray:
        """The first 128 bits of the SHA-256 of the words from each place on, as two numbers."""
        spans = zip(self.starts[places].tolist(), self.ends[places + window - 1].tolist(), strict=True)
        found = b"".join([sha256(self.data[start:end]).digest()[:16] for start, end in spans])
        return np.frombuffer(found, dtype=np.int64).reshape(-1, 2)


def _hashed(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for text in batch.column("text"):
        yield word_hashes(text.as_py(), RAW_WORDS)


def _anchor_counts(window: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """key, n: the anchors' places, added up by chunk."""
        for batch in batches:
            for chunk in chunks(_hashed(batch), window):
                keys, places = anchors(chunk, window)
                _, one = np.unique(places, return_index=True)
                found, n = np.unique(keys[one], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["key", "n"])

    return count


def _anchors_by_text(window: int):
    def list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, key: the anchors of each text."""
        for batch in batches:
            for chunk in chunks(_hashed(batch), window):
                keys, _ = anchors(chunk, window)
                pairs = np.unique(np.stack([chunk.text.astype(np.uint64), keys]), axis=1)
                nodes = batch.column("node").take(pa.array(pairs[0].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(pairs[1].view(np.int64))], names=["node", "key"])

    return list_keys


def _window_digests(window: int, shared):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, place, d1, d2 of the windows whose anchor is found again."""
        for batch in batches:
            own = batch.column("keys") if shared is None else None
            last = (-1, None)
            for chunk in chunks(_hashed(batch), window):
                keys, _ = anchors(chunk, window)
                if own is None:
                    repeated = shared.value
                    at = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
                    which = np.flatnonzero(repeated[at] == keys)
                else:
                    known = {int(i): np.array(own[int(i)].as_py(), dtype=np.int64) for i in np.unique(chunk.text)}
                    hit = np.zeros(len(keys), dtype=bool)
                    for i, of_text in known.items():
                        rows = chunk.text == i
                        hit[rows] = np.isin(keys[rows].view(np.int64), of_text)
                    which = np.flatnonzero(hit)
                texts, places = chunk.text[which], chunk.place[which]
                found = [np.zeros((0, 2), dtype=np.int64)]
                for i in np.unique(texts):
                    if last[0] != i:  # a long text comes in several chunks
                        last = i, Words(batch.column("text")[int(i)].as_py())
                    found.append(last[1].digests(places[texts == i], window))
                digests = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").take(pa.array(texts)),
                        pa.array(places),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                    ],
                    names=["node", "place", "d1", "d2"],
                )

    return read


def _merged(window: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, spans: the words that the windows cover, as flat starts and ends."""
        for batch in batches:
            spans = []
            for places in batch.column("places"):
                at = np.sort(np.array(places.as_py(), dtype=np.int64))
                breaks = np.flatnonzero(np.diff(at) > window)
                starts = at[np.concatenate([[0], breaks + 1])]
                ends = at[np.concatenate([breaks, [len(at) - 1]])] + window
                spans.append(np.stack([starts, ends], axis=1).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(spans, pa.list_(pa.int64()))], names=["node", "spans"]
            )

    return merge


def node_of(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: node, spans of the texts with repeats, and node, keep_id of the texts that have copies."""
    ship(docs.sparkSession)
    plain = picked(docs, doc_id=id_col, text=text_col)
    named = plain.withColumn("node", node_of(F.col("text")))
    copied = written(
        named.groupBy("node")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("node", "keep_id"),
        "copied",
    )
    marked = named.join(small_enough(copied, 64, broadcast_bytes), "node", "left")
    texts = marked.where(F.col("keep_id").isNull() | (F.col("doc_id") == F.col("keep_id"))).select("node", "text")

    counted = texts.select("text").mapInArrow(_anchor_counts(window), "key long, n long")
    again = written(counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "anchors")
    number = again.count()
    node_type = texts.select("node").schema["node"].dataType.simpleString()
    schema = f"node {node_type}, place long, d1 long, d2 long"
    if number == 0:
        windows = texts.select("node", *[F.lit(0).cast("long").alias(c) for c in ("place", "d1", "d2")]).limit(0)
    elif number * 8 <= broadcast_bytes:
        known = np.sort(again.toArrow()["key"].to_numpy().view(np.uint64))
        shared = docs.sparkSession.sparkContext.broadcast(known)
        windows = texts.mapInArrow(_window_digests(window, shared), schema)
    else:
        by_text = texts.mapInArrow(_anchors_by_text(window), f"node {node_type}, key long").distinct()
        keys = by_text.join(again, "key").groupBy("node").agg(F.collect_list("key").alias("keys"))
        windows = texts.join(keys, "node").mapInArrow(_window_digests(window, None), schema)
    windows = written(windows, "windows")
    repeats = windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2")
    # Written, the other side of the join is a plain table too, and Spark may split a window found very often.
    repeats = written(repeats, "repeats")
    places = windows.join(repeats, ["d1", "d2"]).groupBy("node").agg(F.collect_set("place").alias("places"))
    spans = places.mapInArrow(_merged(window), f"node {node_type}, spans array<long>")
    return written(spans, "spans"), copied


def _cut(window: int):
    table = RAW_WORDS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept_texts, digest = [], [], [], []
            columns = [batch.column(c) for c in ("text", "spans", "copied")]
            for text, spans, copied in zip(*columns, strict=True):
                data = (text.as_py() or "").encode(errors="replace")
                words = data.translate(table).split()
                keep = np.ones(len(words), dtype=bool)
                if copied.as_py():
                    keep[:] = len(words) < window
                elif spans.is_valid:
                    for start, end in np.array(spans.as_py()).reshape(-1, 2):
                        keep[start:end] = False
                kept = b" ".join(words if keep.all() else [w for w, k in zip(words, keep, strict=True) if k])
                n_words.append(len(words))
                n_removed.append(int(len(words) - keep.sum()))
                kept_texts.append(None if keep.all() else kept.decode())
                digest.append(sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept_texts, pa.string()),
                    pa.array(digest, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    return cut


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, kept_sha256.

    Words are runs of anything but ASCII white space. Each word covered by a window of `window` words that also
    starts anywhere else is removed, in all places alike. `kept_text` has the remaining words joined by a
    space, and is null where nothing was removed; `kept_sha256` is that of the remaining words in any
    case. A null text has no words. Rows repeated with id and text are copies of each other. An empty
    table gives an empty result.
    """
    spans, copied = repeated_spans(docs, id_col, text_col, window, broadcast_bytes)
    spans = small_enough(spans, 48 + 16 * F.size("spans"), broadcast_bytes)
    copied = small_enough(copied.select("node", F.lit(True).alias("copied")), 64, broadcast_bytes)
    plain = picked(docs, doc_id=id_col, text=text_col)
    rows = plain.withColumn("node", node_of(F.col("text"))).join(spans, "node", "left").join(copied, "node", "left")
    rows = rows.select("doc_id", "text", "spans", F.coalesce("copied", F.lit(False)).alias("copied"))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _cut(window), f"doc_id {id_type}, n_words long, n_removed long, kept_text string, kept_sha256 string"
    )
