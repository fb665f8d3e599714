"""Language of a text: family first, then linear support vector machines within the family.

A text becomes the mean of its lower-cased byte n-grams (one to three bytes) in `PLACES` hashed places. One
set of one-versus-one machines picks the family; within it, each pair of languages has a machine of its own,
which looks at what tells just these two apart. All machines are linear and the features are means, so
a machine's answer is the mean of one weight per n-gram: scoring is a lookup and a sum per text.

The machines are fitted on at most `PER_LANGUAGE` distinct labelled texts of each language, taken by a hash of the text
over all of the table; the executors turn these texts into features, and the driver gets a bounded
matrix. Scoring covers whole texts, in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import boxed, hash_unit, picked, ship, unboxed, written

PLACES = 1 << 12
PER_LANGUAGE = 600
UNDETERMINED = "und"
# A language that wins its closest duel with less than this chance has not been told. Of held-out documents of the test
# tables, 3 in 10,000 have less: some are mostly figures or written in capitals throughout.
TOSS_UP = 0.52
LETTER = r"\p{L}"
PIECE_BYTES = 1 << 20
# Languages by family, fixed values; a language that is not listed is a family by itself.
FAMILIES = {
    "germanic": "en de nl sv da nb nn no is af fy lb",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "turkic": "tr az kk uz ky",
    "indic": "hi mr ne bn pa gu ur",
}
FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members.split()}

_MIX = np.uint64(0x9E3779B97F4A7C15)


def family_of(language: str) -> str:
    return FAMILY_OF.get(language.lower().split("-")[0], language)


def held_out(key: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _places(text: str) -> Iterator[np.ndarray]:
    """The hashed places of all n-grams of the lower-cased text between two spaces, in bounded pieces. A piece
    goes on for two bytes into the next one, where n-grams that begin in it end."""
    data = f" {text.lower()} ".encode(errors="replace")
    for start in range(0, len(data), PIECE_BYTES):
        b = np.frombuffer(data[start : start + PIECE_BYTES + 2], dtype=np.uint8).astype(np.uint64)
        own = min(PIECE_BYTES, len(data) - start)
        pairs = (b[:-1] << np.uint64(8)) | b[1:]
        triples = (pairs[:-1] << np.uint64(8)) | b[2:]
        grams = [(b + np.uint64(1))[:own], (pairs + np.uint64(1 << 10))[:own], (triples + np.uint64(1 << 20))[:own]]
        yield ((np.concatenate(grams) * _MIX) >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)


def features(text: str) -> np.ndarray:
    counts = sum((np.bincount(p, minlength=PLACES) for p in _places(text)), np.zeros(PLACES))
    return (counts / counts.sum()).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Pairs of families and pairs of languages; a machine is positive for the first of its pair."""

    languages: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...]
    weights: np.ndarray  # places x pairs
    biases: np.ndarray

    def predict(self, text: str) -> tuple[str, float]:
        """The language and how sure the least sure of the steps to it is, from 0 to 1."""
        total, n = np.zeros(len(self.pairs)), 0
        for places in _places(text):
            total += self.weights[places].sum(axis=0)
            n += len(places)
        margins = dict(zip(self.pairs, total / n + self.biases, strict=True)) if self.pairs else {}
        families = sorted({family_of(x) for x in self.languages})
        family, sure = _vote([f"family:{x}" for x in families], margins)
        members = sorted(x for x in self.languages if f"family:{family_of(x)}" == family)
        language, surer = _vote(members, margins)
        return language, min(sure, surer)


def _vote(names: list[str], margins: dict[tuple[str, str], float]) -> tuple[str, float]:
    """Who wins most duels, margins breaking ties, and the chance of its closest duel."""
    if len(names) == 1:
        return names[0], 1.0
    won = {name: [0, 0.0] for name in names}
    closest = dict.fromkeys(names, np.inf)
    for a, b in combinations(names, 2):
        margin = float(margins[a, b])
        for name, own in ((a, margin), (b, -margin)):
            won[name][0] += own > 0
            won[name][1] += own
            closest[name] = min(closest[name], own)
    best = max(names, key=lambda name: (won[name], name))
    return best, float(1 / (1 + np.exp(-np.clip(2 * closest[best], -30, 30))))


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 300, cost: float = 1.0) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by accelerated gradient steps on standardised features. `x` is used up:
    it is standardised in place, so that no second matrix of its size is held."""
    mean, scale = x.mean(0), (x.std(0) + 1e-6) * np.float32(np.sqrt(x.shape[1]))
    z = x
    z -= mean
    z /= scale
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    step = 1.0 / (1e-3 + 2 * cost * (1 + float(np.einsum("ij,ij->i", z, z).max())))
    w, b = np.zeros(z.shape[1], dtype=np.float32), 0.0
    v, c = w.copy(), b
    for t in range(rounds):
        slack = (np.maximum(0.0, 1 - y * (z @ v + c)) * y * weight * 2 * cost).astype(np.float32)
        w_next, b_next = v + np.float32(step) * (slack @ z - np.float32(1e-3) * v), c + step * float(slack.sum())
        k = t / (t + 3)
        v, c = w_next + np.float32(k) * (w_next - w), b_next + k * (b_next - b)
        w, b = w_next, b_next
    scaled = w / scale
    return scaled, float(b - scaled @ mean)


def _train(texts: np.ndarray, labels: np.ndarray) -> Model:
    languages = tuple(sorted(set(labels.tolist())))
    families = np.array([f"family:{family_of(x)}" for x in labels])
    pairs, weights, biases = [], [], []
    members = {f: sorted(x for x in languages if f"family:{family_of(x)}" == f) for f in sorted(set(families))}
    for names, of in ((sorted(members), families), *((m, labels) for m in members.values())):
        for a, b in combinations(names, 2):
            rows = (of == a) | (of == b)
            w, bias = _machine(texts[rows], np.where(of[rows] == a, 1.0, -1.0))
            pairs.append((a, b))
            weights.append(w)
            biases.append(bias)
    table = np.stack(weights, axis=1) if weights else np.zeros((PLACES, 0))
    return Model(languages, tuple(pairs), table.astype(np.float32), np.array(biases))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Learn from `text` and `lang` of the rows that aren't held out. None if none of them has both."""
    ship(docs.sparkSession)
    known = picked(docs, doc_id="doc_id", text="text", lang="lang").where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(LETTER)
    )
    # Copies of a text count once: they neither lower the chance of the others nor take their places.
    texts = known.select("lang", F.xxhash64("text").alias("draw")).distinct()
    sizes = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    chance = F.least(F.lit(1.0), F.lit(1.2 * per_language) / F.col("n"))
    drawn = known.join(F.broadcast(sizes), "lang").where(hash_unit(F.col("text")) < chance)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows = batch.to_pydict()
            new = []
            for i, key in enumerate(zip(rows["lang"], rows["draw"], strict=True)):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            if new:
                made = {name: [rows[name][i] for i in new] for name in ("lang", "draw")}
                made["features"] = [features(rows["text"][i]).tobytes() for i in new]
                yield pa.RecordBatch.from_pydict(made)

    schema = "lang string, draw long, features binary"
    sample = written(
        drawn.select("lang", F.xxhash64("text").alias("draw"), "text").mapInArrow(read, schema), "language-sample"
    )
    # The draw holds somewhat more than per_language texts of each language, each once a task; no more than that are
    # taken, each once.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    taken = sample.select("lang", "draw").distinct().withColumn("rank", rank).where(F.col("rank") <= per_language)
    once = sample.join(F.broadcast(taken.drop("rank")), ["lang", "draw"]).dropDuplicates(["lang", "draw"])
    rows = once.select("lang", "features").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["features"]))  # the same model whatever order the tasks ended in
    languages = np.array([r["lang"] for r in rows], dtype=object)
    texts = np.empty((len(rows), PLACES), dtype=np.float32)
    for i in range(len(rows)):
        texts[i], rows[i] = np.frombuffer(rows[i]["features"], dtype=np.float32), None
    return _train(texts, languages)


def predictions(rows: DataFrame, text: Column, model: Model | None) -> DataFrame:
    """The rows, with `lang_pred` and `score`, which replace columns of these names; `und` and 0 for a text without a letter
    or a model."""
    names = [c for c in rows.columns if c.lower() not in ("lang_pred", "score")]
    if model is None:
        return rows.select(*names, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        told = [(None, None) if t is None else shared.value.predict(t) for t in texts]
        return pd.DataFrame(told, columns=["lang_pred", "score"])

    told = rows.select(*names, predict(F.when(text.rlike(LETTER), text)).alias("_told"))
    return told.select(
        *names,
        F.coalesce("_told.lang_pred", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce("_told.score", F.lit(0.0)).alias("score"),
    )


def languages_kept(docs: DataFrame, model: Model | None, least: float = TOSS_UP) -> DataFrame:
    """The documents with a letter whose language is told with a score of `least` or more, with all their columns as they
    are. Without a model, those with a letter."""
    rows = boxed(docs, text="text")
    if model is None:
        return unboxed(rows.where(F.col("text").rlike(LETTER)), docs)
    told = predictions(rows, F.col("text"), model)
    return unboxed(told.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)), docs)
