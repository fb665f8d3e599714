"""The corpus pipeline against plain Python for every stage."""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SMALL
from test_llm_dedup import plain_classes
from test_llm_text import plain_contamination

import __spark_entry__ as registered
import corpus_pipeline
from orderloom.llm import langid, mixing, sharding

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def spark_hash(*values):
    """Spark's xxhash64: each value's hash is the seed of the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=seed).intdigest()
    return seed


def features(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    tokens = [t for t in re.split("[ \t-\r]+", text) if t]
    places = [spark_hash(w) % mixing.WORD_PLACES for w in words]
    return places + [mixing.WORD_PLACES + spark_hash(t[-3:]) % mixing.ENDING_PLACES for t in tokens], len(tokens)


def plain_mixture(docs, labels):
    """doc_id -> copies."""
    read = {i: features(t) for i, t in docs}
    size = mixing.WORD_PLACES + mixing.ENDING_PLACES
    sample = [(read[i][0], answers) for i, *answers in labels if i in read]
    odds = {i: [] for i in read}
    for q in range(2):
        counts = {}
        for a in (0, 1):
            own = [f for f, answers in sample if answers[1 - q] == a]
            tokens, texts = np.zeros(size), np.zeros(size)
            for f in own:
                np.add.at(tokens, f, 1)
                texts[list(set(f))] += 1
            counts[a] = tokens, texts, len(own)

        def ratios(k, totals):
            yes, no = counts[1][k], counts[0][k]
            (n_yes, n_no) = totals
            if not n_yes or not n_no:
                return np.zeros(size)
            share = (yes + no) / (n_yes + n_no)
            error = np.sqrt(share * (1 / n_yes + 1 / n_no))
            ratio = np.log((yes + 0.5) / n_yes) - np.log((no + 0.5) / n_no)
            tells = (abs(yes / n_yes - no / n_no) > mixing.Z_SCORE * error) & (abs(ratio) > math.log(mixing.RATIO))
            return np.where(tells, ratio, 0)

        by_token = ratios(0, (counts[1][0].sum(), counts[0][0].sum()))
        by_text = ratios(1, (counts[1][2], counts[0][2]))
        told = np.where(by_token * by_text > 0, np.rint(by_token * 1e6), 0)
        plain = [answers[1 - q] for f, answers in sample if not told[f].any()]
        prior = round(math.log((plain.count(1) + 0.5) / (plain.count(0) + 0.5)) * 1e6)
        for i, (f, _) in read.items():
            odds[i].append(1 / (1 + math.exp(-(prior + told[list(set(f))].sum()) / 1e6)))
    ids = list(read)
    toxic, good = (np.array([odds[i][q] for i in ids]) for q in (0, 1))
    p = np.stack([(1 - toxic) * good, (1 - toxic) * (1 - good), toxic], axis=1)
    tokens = np.array([read[i][1] for i in ids], dtype=float)
    rate = np.ones(len(ids))
    share = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    goal = share * ((tokens @ p)[0] / share[0])
    for _ in range(mixing.STEPS):
        residual = (rate * tokens) @ p - goal
        if np.linalg.norm(residual) <= mixing.CLOSE * goal.sum():
            break
        live = rate > 0
        gram = (p[live] * tokens[live, None]).T @ p[live]
        rate = np.maximum(0, rate - p @ (np.linalg.pinv(gram, hermitian=True) @ residual))
    out = {}
    for i, r in zip(ids, rate, strict=True):
        chance = (spark_hash(i, "copies") >> 11) / 2**53
        out[i] = math.floor(r) + (chance < r - math.floor(r))
    return out


def plain_pipeline(docs, benchmark, labels, model):
    docs = [(i, t) for i, t in docs if t is not None and any(c.isalpha() for c in t)]
    docs = [(i, t) for i, t in docs if model.predict(t)[1] >= langid.TOSS_UP]
    kept = {i for i, least, _ in plain_classes(docs) if i == least}
    docs = [(i, t) for i, t in docs if i in kept]
    bad = {i for i, *_, contaminated in plain_contamination(docs, benchmark) if contaminated}
    docs = [(i, t) for i, t in docs if i not in bad]
    copies = plain_mixture(docs, labels)
    owners = sharding.fill(sharding.shard_names())
    out = Counter()
    for i, n in copies.items():
        slot = int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        out[i, slot, owners[slot]] += n
    return +out, len(kept), len(bad)


def test_pipeline_on_whole_tables(spark):
    docs, benchmark, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark", "labels"))
    want, _, bad = plain_pipeline(
        [(r.doc_id, r.text) for r in docs.collect()],
        [(r.item_id, r.text) for r in benchmark.collect()],
        [(r.doc_id, r.quality, r.toxic) for r in labels.collect()],
        langid.fit(docs),
    )
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == [*docs.columns, "slot", "shard"]
    assert bad > 0
    assert Counter(tuple(r) for r in got.select("doc_id", "slot", "shard").collect()) == want
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id] == r.text for r in got.collect())


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with the three tables, as given."""

    def write(docs, benchmark=(), labels=()):
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, node int, "
                              "shard string, spans string").write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return write


def row(doc_id, text, lang="en"):
    return doc_id, text, lang, None, None, 1, "x", "y"


def test_stages_on_odd_rows(spark, tables):
    base = " ".join(f"base{i}" for i in range(60))
    passage = " ".join(f"item{i}" for i in range(20))
    docs = [row(1, None), row(2, ""), row(3, "12 34 !?"), row(4, base), row(5, base + " end"), row(6, base)]
    docs += [row(7, passage), row(8, f"{passage} " + " ".join(f"own{i}" for i in range(500))), row(None, "no id here")]
    docs += [row(9, "word " * 100_000, None), row(10, "twice the same"), row(10, "twice the same"), row(11, "des mots", "fr")]
    folder = tables(docs, [(1, passage)], [(4, 1, 0)])
    state = spark.read.parquet(f"{folder}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, folder)
        if name != "shards":
            assert state.columns == [*COLUMNS, "node", "shard", "spans"]
        left.append(Counter(r.doc_id for r in state.collect()))
    start = Counter(d[0] for d in docs)
    assert left[0] == start - Counter([1, 2, 3])
    assert left[1] == left[0] - Counter([5, 6])
    assert left[2] == left[1] - Counter([7])
    assert left[3] == left[2] == left[4]
    assert state.columns == [*COLUMNS, "node", "spans", "slot", "shard"]


def test_empty_tables(spark, tables):
    folder = tables([], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_without_labels_or_benchmark(spark, tables):
    folder = tables([row(1, "a text"), row(2, "another one, quite different")])
    assert corpus_pipeline.run(spark, folder).count() == 2


def test_stages_are_registered():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixture", "shards"]
    queries = registered.queries()
    assert "pipeline" in queries and [sum(q.startswith(f"op{n}_") for q in queries) for n in range(1, 11)] == [1] * 10

