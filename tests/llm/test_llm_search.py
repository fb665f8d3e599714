"""Ranked search against a plain reading of the score."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderloom.llm import lemp

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, doc_id long, score double, rank string, terms string, length int, item string, n int"


def table(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([(t, i, 0.5, "x", "y", 1, "z", 2) for i, t in rows], SCHEMA)


def items(spark, rows):
    return spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, item_id string, doc_id string")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, asked, top=50):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    total = sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in dict.fromkeys(asked):
        scores = []
        for i, c, n in held:
            m = 50 + (50 * n * len(held)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[w] + 1)))
                * ((10**9 * c[w]) // (1000 * c[w] + 20 * m))
                for w in set(terms(text)) & set(c)
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def prose(rng, n, words=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.choice([3, 20, 120, 700]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(120)]  # ties beyond the last place
    docs += [(None, None), (2000, ""), (2001, "... !"), (None, "w3 w5 Ünïcode"), (None, "w3 w5"), (5, docs[5][1])]
    docs += [(2002, "w1 " * 30_000 + "w399")]
    asked = [(f"q{i}", prose(rng, 25)) for i in range(30)]
    asked += [("same", "W3 w5 ÜNÏCODE"), ("same", "W3 w5 ÜNÏCODE"), (None, "w9 w11"), ("none", None), ("blank", "?"), ("far", "zzz")]
    return docs, asked


@pytest.mark.parametrize(("bucket", "block_bytes"), [(4096, 1 << 23), (16, 1 << 23), (64, 1000)])
def test_ranks(spark, corpus, bucket, block_bytes):
    docs, asked = corpus
    found = lemp.ranked(table(spark, docs).repartition(3), items(spark, asked), bucket=bucket, block_bytes=block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert shown(found) == plain(docs, asked)


def test_fewer_places(spark, corpus):
    docs, asked = corpus
    assert shown(lemp.ranked(table(spark, docs), items(spark, asked), top=3)) == plain(docs, asked, 3)


def test_empty_tables(spark):
    docs, asked = table(spark, [(1, "a b")]), items(spark, [("q", "a")])
    assert lemp.ranked(docs.limit(0), asked).collect() == []
    assert lemp.ranked(docs, asked.limit(0)).collect() == []
    assert lemp.ranked(docs, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert lemp.ranked(table(spark, [(1, None)]), asked).collect() == []


def test_bounds_lose_nothing_and_leave_most_vectors_out():
    rng = np.random.default_rng(2)
    n, size = 3000, 300
    weights = np.sort(rng.integers(0, 9000, size))
    stats = lemp.Statistics(n, n * 40, weights)
    roots = np.sqrt(weights.astype(float))
    terms = [np.sort(rng.choice(size, rng.integers(1, 60), replace=False, p=np.arange(size, 0, -1) / (size * (size + 1) / 2))) for _ in range(n)]
    impacts = [stats.impacts(rng.integers(1, 5, len(t)), len(t)) for t in terms]
    lengths = np.array([np.sqrt(((roots[t] * x) ** 2).sum()) for t, x in zip(terms, impacts, strict=True)])
    order = np.argsort(-lengths)
    queries = [np.sort(rng.choice(size, 12, replace=False)) for _ in range(20)]
    search = lemp.Search(queries, stats, 10)
    for start in range(0, n, 200):
        part = order[start : start + 200]
        ends = np.append(0, np.cumsum([len(terms[i]) for i in part]))
        bucket = lemp.Bucket(
            lengths[part], np.concatenate([terms[i] for i in part]), np.concatenate([impacts[i] for i in part]), ends, roots
        )
        search.take(bucket, pa.array(part))
    for q, best in zip(queries, search.best, strict=True):
        scores = [int(sum(weights[k] * v for k, v in zip(t, x, strict=True) if k in q)) for t, x in zip(terms, impacts, strict=True)]
        assert best == sorted(((s, i) for i, s in enumerate(scores) if s), key=lambda e: (-e[0], e[1]))[:10]
    assert search.verified < 0.5 * n * len(queries)
