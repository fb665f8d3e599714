"""The manifest and its proofs against a plain reading."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.llm import merkle

SCHEMA = "root string, doc_id long, text string, source string, lang string, n_chars long, place int, tree string, nodes long"


def table(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([("x", i, t, s, g, n, 3, "y", 4) for i, s, g, n, t in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return sha("".join(map(part, row)))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def steps(levels, place):
    for level in levels[:-1]:
        start = place // 16 * 16
        run = level[start : start + 16]
        yield "".join(run[: place - start]), "".join(run[place - start + 1 :])
        place //= 16


def plain(rows, tampered=lambda i: False):
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for place, (*_, digest, row) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            path = [*steps(trees[s], place), *steps(top, at)]
            fold = leaf((*row[:4], lowered(row[4]))) if tampered(row[0]) else digest
            for before, after in path:
                fold = sha(before + fold + after)
            proof = sha("".join(b + a for b, a in path))
            out.append((row[0], s, digest, trees[s][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(out, key=str)


def shown(df):
    assert df.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            i += 1
            text = rng.choice([None, "", "Text", "lower", f"Text {i}", "Ünï " * 5])
            rows.append((i * 7919 % 100_003, source, rng.choice([None, "en", ""]), rng.choice([None, 3]), text))
    rng.shuffle(rows)
    return rows


ODD_IDS = lambda i: i is not None and i % 2 == 1


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 2, None: 1, "": 3},
        {"a": 16, "b": 17, "é": 15, None: 1},
        {"hot": 4200, "b": 256, "c": 257, "d": 31},
        {f"s{i}": 1 + i % 3 for i in range(300)},
    ],
    ids=["one", "null and empty", "runs", "hot", "many sources"],
)
@pytest.mark.parametrize("stride", [1, 2])
def test_proofs(spark, sizes, stride):
    rows = rows_of(sizes)
    got = merkle.verified(table(spark, rows).repartition(5), F.col("doc_id") % 2 == 1, stride)
    assert shown(got) == plain(rows, ODD_IDS)


def test_null_and_repeated_rows(spark):
    rows = [(None, None, None, None, None)] * 3 + [(None, "s", "en", 1, "A")] * 20 + [(5, "s", "en", 1, "A")] * 40
    rows += [(5, "s", "en", 1, "B"), (6, "s", None, 10**15, "long " * 100_000)]
    got = merkle.verified(table(spark, rows), F.col("doc_id") % 2 == 1)
    assert shown(got) == plain(rows, ODD_IDS)


def test_without_tampering_all_rows_are_verified(spark):
    rows = rows_of({"a": 40, "b": 3})
    assert {r["verified"] for r in merkle.verified(table(spark, rows)).collect()} == {True}


def test_a_change_shows(spark):
    rows = rows_of({"a": 40, "b": 3})
    one = merkle.verified(table(spark, rows)).head()["root"]
    other = merkle.verified(table(spark, [*rows[:-1], (*rows[-1][:4], "changed")])).head()["root"]
    assert one != other


def test_empty_table(spark):
    assert merkle.verified(table(spark, [(1, "a", "en", 1, "t")]).limit(0)).collect() == []


def test_no_task_gets_a_source(spark, conf):
    """What is grouped are subtrees; rows of one source are dealt out in ranges."""
    rows = [(i, "hot", "en", 1, "t") for i in range(3000)]
    numbered = merkle.placed(
        table(spark, rows).select("doc_id", F.lit("t").alias("tree"), F.sha2(F.col("doc_id").cast("string"), 256).alias("digest")),
        "tree",
        ["doc_id"],
    )
    assert [(r["doc_id"], r["place"], r["nodes"]) for r in numbered.orderBy("place").collect()] == [
        (i, i, 3000) for i in range(3000)
    ]
    levels, _ = merkle.manifest(numbered, 2, "test")
    assert max(len(r["digests"]) for r in levels[0].collect()) == 256 and levels[0].count() == 12
