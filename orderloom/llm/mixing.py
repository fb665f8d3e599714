"""Document rates that bring the token totals of soft domains to target shares.

A classifier learned from the labelled table gives each document a probability for each domain, and a
document counts for all domains in these parts. Rates r >= 0, one per document, are fitted so that the
expected totals  sum(r * tokens * p_k)  become  share_k * budget.  That is a least-squares problem with
as many unknowns as documents and as many equations as domains. It is solved by projected gradient steps
from r = 1: the residual, one number per domain, is a distributed sum; the step
r <- max(0, r - p . w) with w = G^-1 residual is taken by each row for itself, where G, the sum of
tokens * p p' over the rows whose rate is above 0, scales the gradient so that a step of one is right for
any data while rates stay above 0; the steps to the least residual are kept. The driver holds a vector per domain
and step, the documents are never gathered or shuffled, and a document's rate depends on its probabilities only,
so long texts aren't preferred.

Two yes-or-no questions make the domains: is a text toxic, and if not, is it of good quality? For each, the
classifier counts how often a feature occurs in labelled texts of either answer (lower-cased words and the
last characters of tokens, hashed to a fixed number of places). It keeps the features whose rates differ
by `Z_SCORE` standard errors and by a factor of `RATIO`, by tokens and by texts alike, so that neither
one long text nor the longer texts of one answer make a feature. The log ratios of those a text has
are added up; a text that has none gets the odds of labelled texts that have none. It is
fitted on at most `LABELLED` labelled texts; everything else covers all documents.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import bitmaps
from orderloom.llm.common import boxed, hash_unit, picked, unboxed, words_of, written

LOG = logging.getLogger(__name__)

WORD_PLACES = 1 << 14
ENDING_PLACES = 1 << 12
LABELLED = 20_000
Z_SCORE = 5.0
RATIO = 3.0
STEPS = 40
CLOSE = 1e-7
HALVED = 12
TARGETS = {"clean": 0.80, "poor": 0.15, "toxic": 0.05}
DOMAINS = ("clean", "poor", "toxic")
QUESTIONS = ("toxic", "quality")
# Domains that are never raised: their goal is no more than they have, and a text likely of them counts once at most.
UNWANTED = ("toxic",)
# Weights are kept as whole millionths, so that sums do not depend on their order.
UNIT = 1_000_000


def tokens_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+"), lambda w: w != "")


def _features(text: Column) -> Column:
    """The places of a text's words and token endings, as often as they occur."""
    words = F.transform(words_of(text), lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_PLACES)))
    endings = F.transform(
        tokens_of(text), lambda w: WORD_PLACES + F.pmod(F.xxhash64(F.substring(w, -3, 3)), F.lit(ENDING_PLACES))
    )
    return F.concat(words, endings)


@dataclass(frozen=True)
class Classifier:
    """For each question the log odds before reading and, by place, the log ratio of yes to no, in units."""

    priors: tuple[int, ...]
    weights: tuple[tuple[int, ...], ...]
    texts: int


def _table(values) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _log_ratios(yes: np.ndarray, no: np.ndarray, n_yes: float, n_no: float, z_score: float) -> np.ndarray:
    """Log ratio of the rates; 0 where they don't tell the answers apart."""
    if not n_yes or not n_no:
        return np.zeros(len(yes))
    share = (yes + no) / (n_yes + n_no)
    error = np.sqrt(share * (1 / n_yes + 1 / n_no))
    ratio = np.log((yes + 0.5) / n_yes) - np.log((no + 0.5) / n_no)
    tells = (np.abs(yes / n_yes - no / n_no) > z_score * error) & (np.abs(ratio) > math.log(RATIO))
    return np.where(tells, ratio, 0.0)


def _counted(read: DataFrame, places: Column) -> dict[str, np.ndarray]:
    """By question and answer, how often each place occurs. The driver gets a row per place at most."""
    names = [(q, a, f"{q}{a}") for q in QUESTIONS for a in (0, 1)]
    counts = read.select(*QUESTIONS, F.explode(places).alias("place")).groupBy("place")
    out = {name: np.zeros(WORD_PLACES + ENDING_PLACES) for *_, name in names}
    for row in counts.agg(*[F.sum((F.col(q) == a).cast("int")).alias(name) for q, a, name in names]).collect():
        for name, column in out.items():
            column[row["place"]] = row[name] or 0
    return out


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, z_score: float = Z_SCORE) -> Classifier:
    """Learn from at most `labelled` of the labels, taken by a hash of the id. A null label is no answer; to a
    question with one kind of answer only, that is the likely one for all texts."""
    given = picked(labels, doc_id="doc_id", **{q: q for q in QUESTIONS})
    answers = given.select("doc_id", *[F.col(q).cast("int").alias(q) for q in QUESTIONS])
    sample = answers.where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id", *QUESTIONS).limit(labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    read = written(texts.select(*QUESTIONS, _features(F.col("text")).alias("places")), "labelled")
    tokens, texts_with = _counted(read, F.col("places")), _counted(read, F.array_distinct("places"))
    priors, weights, labelled_texts = [], [], read.count()
    for q in QUESTIONS:
        yes, no = f"{q}1", f"{q}0"
        n_no, n_yes = [float(n or 0) for n in read.agg(*[F.sum((F.col(q) == a).cast("int")) for a in (0, 1)]).head()]
        rates = _log_ratios(tokens[yes], tokens[no], tokens[yes].sum(), tokens[no].sum(), z_score)
        shares = _log_ratios(texts_with[yes], texts_with[no], n_yes, n_no, z_score)
        told = np.where(rates * shares > 0, np.rint(rates * UNIT), 0).astype(int)
        plain = _without(read, [int(w != 0) for w in told])
        n_no, n_yes = [n or 0 for n in plain.agg(*[F.sum((F.col(q) == a).cast("int")) for a in (0, 1)]).head()]
        priors.append(round(math.log((n_yes + 0.5) / (n_no + 0.5)) * UNIT))
        weights.append(tuple(told.tolist()))
    return Classifier(tuple(priors), tuple(weights), labelled_texts)


def _without(read: DataFrame, telling: list[int]) -> DataFrame:
    table = _table(telling)
    return read.where(~F.exists("places", lambda f: table[f.cast("int")] == 1))


def _score(prior: int, weights: tuple[int, ...]) -> Column:
    table = _table(weights)
    return F.aggregate("__told", F.lit(prior).cast("bigint"), lambda s, f: s + table[f.cast("int")])


def _weighted(docs: DataFrame, text: Column, classifier: Classifier) -> DataFrame:
    """The rows with `__tokens` and `__p`, the probabilities in the order of DOMAINS."""
    used = _table([int(any(column)) for column in zip(*classifier.weights, strict=True)])
    told = docs.withColumns(
        {
            "__tokens": F.size(tokens_of(text)).cast("bigint"),
            "__told": F.array_distinct(F.filter(_features(text), lambda f: used[f.cast("int")] == 1)),
        }
    )
    scored = told.withColumns(
        {
            f"__{q}": F.lit(1.0) / (F.lit(1.0) + F.exp(-_score(prior, weights) / F.lit(float(UNIT))))
            for q, prior, weights in zip(QUESTIONS, classifier.priors, classifier.weights, strict=True)
        }
    ).drop("__told")
    toxic, good = F.col("__toxic"), F.col("__quality")
    domains = F.array((1 - toxic) * good, (1 - toxic) * (1 - good), toxic)
    return scored.withColumn("__p", domains).drop("__toxic", "__quality")


def _rate(steps: list[list[float]]) -> Column:
    """A row's rate after the steps taken so far: from 1, each step moves along `__p`, down to 0, and up to 1 for a text
    likely unwanted. The steps are data of the expression, so that a further step needs no new code."""
    if not steps:
        return F.lit(1.0)
    k = len(DOMAINS)
    unwanted = sum(F.col("__p")[DOMAINS.index(d)] for d in UNWANTED)
    most = F.when(unwanted > 0.5, F.lit(1.0)).otherwise(F.lit(float("inf")))
    table = F.split(F.lit(",".join(repr(w) for step in steps for w in step)), ",").cast("array<double>")
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(len(steps) - 1)),
        F.lit(1.0),
        lambda rate, t: F.least(
            most,
            F.greatest(
                F.lit(0.0),
                rate - sum((F.col("__p")[i] * table[t * k + i] for i in range(1, k)), F.col("__p")[0] * table[t * k]),
            ),
        ),
    )


def _sums(weighted: DataFrame, steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """The domains' totals at the rates so far, and the sum of tokens * p p' over rows whose rate isn't 0."""
    k, p = len(DOMAINS), F.col("__p")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rated = weighted.withColumn("__rate", _rate(steps))
    live = F.when(F.col("__rate") > 0, F.col("__tokens")).otherwise(F.lit(0))
    sums = rated.agg(
        *[F.sum(F.col("__rate") * F.col("__tokens") * p[i]) for i in range(k)],
        *[F.sum(live * p[i] * p[j]) for i, j in pairs],
    ).head()
    gram = np.zeros((k, k))
    for (i, j), value in zip(pairs, sums[k:], strict=True):
        gram[i, j] = gram[j, i] = value or 0.0
    return np.array([t or 0.0 for t in sums[:k]]), gram


def fit_rates(weighted: DataFrame, targets: Mapping[str, float]) -> list[list[float]]:
    """The steps that lead from a rate of 1 to the fitted rates.

    The budget is what the clean domain's tokens make at its target share, so clean texts are neither thinned
    out nor repeated to speak of; without clean tokens it is all tokens. Shares of domains that do
    not occur are dealt out among the others. Toxic texts are thinned out to their share, and stay as they are where
    they have less. Their target should be above 0: hardly a text is surely not toxic, so a total of 0 would leave
    the few surest texts only, many times over.

    Whole steps may raise the residual for a while on their way to the targets (halving these at once ends
    early, off targets that can be reached). If `STEPS` of them don't reach the targets, `HALVED` more start
    from the best, and those that do not lower the residual are halved. The steps to the least residual are
    returned; it is logged, as a warning where the targets are not met.
    """
    totals, gram = _sums(weighted, [])
    share = np.array([max(targets.get(d, 0.0), 0.0) for d in DOMAINS]) * (totals > 0)
    if not totals.sum() or not share.sum():
        return []
    share = share / share.sum()
    goal = share * (totals[0] / share[0] if share[0] else totals.sum())
    unwanted = [DOMAINS.index(d) for d in UNWANTED]
    goal[unwanted] = np.minimum(goal[unwanted], totals[unwanted])
    steps: list[list[float]] = []
    off = float(np.linalg.norm(totals - goal) / goal.sum())
    best = off, steps, totals, gram
    size, tried = 1.0, 0
    while best[0] > CLOSE and tried < STEPS + HALVED:
        if tried >= STEPS:  # whole steps did not lead there: from the best, those that lower the residual
            off, steps, totals, gram = best
        step = [float(size * w) for w in np.linalg.pinv(gram, hermitian=True) @ (totals - goal)]
        steps = [*steps, step]
        totals, gram = _sums(weighted, steps)
        off = float(np.linalg.norm(totals - goal) / goal.sum())
        tried += 1
        if off < best[0]:
            best = off, steps, totals, gram
        elif tried > STEPS:
            size /= 2
    off, steps, *_ = best
    LOG.log(
        logging.INFO if off <= CLOSE else logging.WARNING,
        "mixing: after %d steps the totals are off their targets by %.3g of the budget", len(steps), off,
    )
    return steps


def _fitted(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_col: str, text_col: str):
    plain = picked(docs, doc_id=id_col, text=text_col)
    classifier = fit(plain, labels)
    weighted = written(_weighted(plain, F.col("text"), classifier).drop("text"), "weighted")
    return classifier, weighted, fit_rates(weighted, targets) if classifier.texts else []


def _repeated(ids: DataFrame) -> Column | None:
    """Whether `doc_id` may be on several rows: a bitmap of those that are, none if there are none."""
    several = ids.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bitmap = bitmaps.gathered(several, bitmaps.bit_of(F.col("doc_id")))
    return bitmaps.constant(bitmap) if any(bitmap) else None


def _copies(rate: Column, key: Column, repeated: Column | None) -> Column:
    """A whole number whose mean is the rate, by a hash of the id. Rows without an id of their own would share
    the coin, so theirs is of the row. (Hashes skip nulls, so the row's number is no part of the others' coin.)"""
    shared = key.isNull()
    if repeated is not None:
        shared = shared | bitmaps.holds(repeated, bitmaps.bit_of(key))
    coin = hash_unit(key, F.lit("copies"), F.when(shared, F.monotonically_increasing_id()))
    return (F.floor(rate) + (coin < rate - F.floor(rate)).cast("bigint")).cast("int")


def rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, tokens, domain (the likeliest), p_clean, p_poor, p_toxic, rate, copies.

    A null or empty text has no tokens and no words, so it has the prior probabilities. Rows repeated
    with id and text get the same rate and count as often as they come; rows that share an id, or have none, are
    rounded each by itself, so that one run may keep others of them than the next. Without labelled texts or
    tokens all rates are 1. An empty table gives an empty result.
    """
    _, weighted, steps = _fitted(docs, labels, targets, id_col, text_col)
    p = F.col("__p")
    likeliest = F.array_position(p, F.array_max(p)) - 1
    return weighted.withColumn("rate", _rate(steps)).select(
        "doc_id",
        F.col("__tokens").alias("tokens"),
        F.array(*[F.lit(d) for d in DOMAINS])[likeliest.cast("int")].alias("domain"),
        *[p[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
        "rate",
        _copies(F.col("rate"), F.col("doc_id"), _repeated(weighted.select("doc_id"))).alias("copies"),
    )


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents, each as often as its rate says, with their columns. Texts aren't shuffled."""
    classifier, weighted, steps = _fitted(docs, labels, targets, id_col, text_col)
    rated = _weighted(boxed(docs, doc_id=id_col, text=text_col), F.col("text"), classifier)
    copies = _copies(_rate(steps), F.col("doc_id"), _repeated(weighted.select("doc_id")))
    # An outer generator keeps Catalyst from working out the rate a second time in a filter below it.
    times = rated.select("row", F.explode_outer(F.array_repeat(F.lit(1), copies)).alias("copy"))
    return unboxed(times.where(F.col("copy").isNotNull()), docs)
