"""Token counts against the tokenizer's own library."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from orderloom.llm import token_counts as tc

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "n_tokens string, text string, doc_id long, node string, k int, piece string, n_bytes string"


def table(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([("x", t, i, "y", 1, "z", "v") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    return tc.Machine(tc.vocabulary(MODEL))


ODD = [
    "", " ", "   ", "a", " a", "a ", "\n", "\t\tx", "\x00", "<s>", "</s> x", "<unk>", "<0x0A>", "▁", "▁▁x", "a▁b", "﻿x",
    "é", "ﬁ", "日本語テスト", "👩‍👩‍👧", "x" * 500, "a" * 301, " " * 90, "1234567890" * 9, "\r\n", "Ünïcode ÉCOLE",
]


def test_odd_texts(machine, library):
    assert {t: machine.count(t) for t in ODD} == {t: len(library.encode(t)) for t in ODD}


def test_random_texts(machine, library):
    rng = random.Random(4)
    letters = "aabtheingr ßéжш中文日本の😀‍0123 .,<s></s>\n\t   "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(4000)]
    assert [machine.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_documents(machine, library):
    rows = duckdb.connect().execute("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    texts = [t for (t,) in rows if t is not None]
    assert [machine.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_few_states_at_a_time(library):
    small = tc.Machine(tc.vocabulary(MODEL), most_states=50)
    texts = ["what comes of compiled states that are given up again", "überall wo ein Wort beginnt"] * 3
    assert [small.count(t) for t in texts] == [len(x) for x in library.encode(texts)]
    assert len(small.states) <= 60


def test_state_maps_compose_in_any_grouping(machine, library):
    rng = random.Random(6)
    text = "".join(rng.choice("abtheing 中é") for _ in range(3000)).replace(" ", tc.SPACE)
    state, first = machine.start()
    parts = [text[i : i + 97] for i in range(0, len(text), 97)]
    maps = [tc.state_map(machine, [state], parts[0])]
    for i, part in enumerate(parts[1:], 1):
        before = "".join(parts[:i])[-tc.REACH :]
        maps.append(tc.state_map(machine, tc.entry_states(machine, before), part))
    left = maps[0]
    for other in maps[1:]:
        left = tc.composed(left, other)
    whole = tc.scanned(maps)
    assert whole == left
    assert first + whole[state.key()][1] == len(library.encode(text.replace(tc.SPACE, " ")))


def rows_of(texts):
    rows = list(enumerate(texts)) + [(None, None), (None, "no id"), (7, "twice"), (7, "twice"), (8, None)]
    return rows


def wanted(library, rows, limit):
    out = Counter()
    for i, t in rows:
        n = len(library.encode(t or ""))
        out[i, len((t or "").encode()), n, n > limit] += 1
    return out


def test_counts(spark, library):
    rows = rows_of(ODD)
    got = tc.token_counts(table(spark, rows), MODEL, limit=20)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, got.collect())) == wanted(library, rows, 20)


def test_chunks_of_long_texts(spark, library):
    rng = random.Random(9)
    words = ["the", "meaning", "überall", "中文", "x" * 300, "  ", "1999", "\n"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (30, 400, 2500)]
    texts += ["a" * 5001, "ab" * 3000, " " * 4000, "日本" * 2000, texts[2], texts[2]]
    rows = rows_of(texts + ODD)
    got = tc.token_counts(table(spark, rows), MODEL, limit=100, chunk=190)
    assert Counter(map(tuple, got.collect())) == wanted(library, rows, 100)


def test_maps_that_do_not_compose_are_made_up_for(spark, library, monkeypatch):
    def no_map_composes(shared):
        def scan(batches):
            for batch in batches:
                nulls = pa.nulls(len(batch), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("node"), nulls], names=["node", "n_tokens"])

        return scan

    monkeypatch.setattr(tc, "_scanned", no_map_composes)
    rows = [(1, "some words " * 50), (2, "few")]
    got = tc.token_counts(table(spark, rows), MODEL, chunk=100)
    assert Counter(map(tuple, got.collect())) == wanted(library, rows, tc.LIMIT)


def test_empty_table(spark):
    assert tc.token_counts(table(spark, [(1, "a")]).limit(0), MODEL).collect() == []
