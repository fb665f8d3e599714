"""Decontamination, personal data, licences, language, mixing and shards against plain readings of their rules."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.llm import decontam, langid, license_scan, mixing, pii, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "row string, doc_id long, text string, spans string, words int, start int"


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([("r", i, t, "s", 1, 2) for i, t in rows], SCHEMA)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- decontamination --------------------------------------------------------------------------


def plain_contamination(docs, benchmark):
    out = []
    windows = defaultdict(set)
    for item, text in benchmark:
        words = WORD.findall(lowered(text))
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    for doc_id, text in docs:
        words = WORD.findall(lowered(text))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if ids := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        named = ",".join(sorted(found))
        out.append((doc_id, len(words), len(hit), len(found), named, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return Counter(out)


def sets():
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(50)] + ["É", "ß9", "x"]
    text = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    benchmark = [(i, text(n)) for i, n in enumerate((13, 14, 30, 60, 12, 5, 1))]
    benchmark += [(50, None), (51, "..."), (52, benchmark[2][1]), (520, benchmark[2][1].upper()), (None, text(20))]
    docs = [(1, None), (2, ""), (3, "!?"), (4, "x"), (5, benchmark[3][1]), (5, benchmark[3][1]), (None, benchmark[2][1])]
    for i in range(60):
        words = text(random.choice([5, 40, 400])).split()
        for _ in range(random.randrange(3)):
            at = random.randrange(len(words) + 1)
            words[at:at] = random.choice(benchmark[:6])[1].split()
        docs.append((100 + i, random.choice([" ", ", ", "\n"]).join(words).title()))
    docs.append((400, " ".join([text(40_000), benchmark[3][1]])))
    return docs, benchmark


@pytest.mark.parametrize("limit", [decontam.BROADCAST_BYTES, 0])
def test_contamination(spark, limit):
    docs, benchmark = sets()
    got = decontam.contamination(table(spark, docs), items(spark, benchmark), broadcast_bytes=limit)
    got = got.select("doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ","), "contaminated")
    assert Counter(map(tuple, got.collect())) == plain_contamination(docs, benchmark)


def test_a_full_bitmap_loses_nothing(spark, monkeypatch):
    docs, benchmark = sets()
    monkeypatch.setattr(decontam.scanned, "__defaults__", (64,))
    got = decontam.contamination(table(spark, docs), items(spark, benchmark))
    got = got.select("doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ","), "contaminated")
    assert Counter(map(tuple, got.collect())) == plain_contamination(docs, benchmark)


def test_contamination_of_empty_tables(spark):
    docs, benchmark = sets()
    assert decontam.contamination(table(spark, docs).limit(0), items(spark, benchmark)).count() == 0
    none = decontam.contamination(table(spark, docs), items(spark, benchmark).limit(0))
    assert none.count() == len(docs) and none.where("n_hit > 0 or contaminated or n_items > 0").count() == 0


def test_documents_and_spans_are_removed(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    docs = table(spark, [(1, passage), (2, f"Before, ({passage.upper()}) after!" + " own" * 300), (None, "clean")])
    clean = decontam.clean_documents(docs, items(spark, [(1, passage)]))
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {2, None}
    found = decontam.contamination(docs, items(spark, [(1, passage)])).select("doc_id", F.col("spans").alias("hit"))
    cut = docs.join(found, "doc_id").select("doc_id", decontam.without_spans(F.col("text"), F.col("hit")).alias("t"))
    told = {r["doc_id"]: r["t"] for r in cut.collect()}
    assert told[1] == "" and told[2] == "Before) after!" + " own" * 300


# --- personal data ----------------------------------------------------------------------------

PLAIN = {kind: re.compile(pattern) for kind, (pattern, *_) in pii.KINDS.items()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(PLAIN.items())
        for m in pattern.finditer(text or "")
        if valid(kind, m[0])
    ]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


PERSONAL = [
    None,
    "",
    "a@b.c d@e f@g.h.i. @j.k l@m..n o@-.p",
    "x@y@z.w u%v+w@q-r.s-t.com,é@é.com é.a@b.cd",
    "a@b.c+d@e.f g@h.i@j.k",
    "1.2.3.4 255.255.255.255 256.1.1.1 1.2.3 1.2.3.4.5.6.7.8 0255.1.1.0001 9.9.9.9999",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 4111  1111 1111 1111 41111111111111111111111",
    "0000 0000 0000 00000000 0000-0000-0000",
    "+1 (743) 555-3824, +12 345 678 9+49 (0)30 1234567 ++1 2 3 4 5 6 7 8 9 0 +1234567890123456 +1()",
    "日本 a@b.jp 𝒳 1.2.3.4 \x01 \x02 +1 234 567 890\x014111111111111111",
    "1" * 3000 + " " + "1 " * 3000 + "a" * 3000 + "@ " + "a." * 3000 + "@b" + ".c" * 3000 + " " + "+1 " * 3000,
]


def test_base_findings(spark):
    random.seed(6)
    alphabet = "ab1239.@+-() %_\n,é𝒳"
    texts = PERSONAL + ["".join(random.choice(alphabet) for _ in range(random.randrange(60))) for _ in range(1500)]
    rows = list(enumerate(texts)) + [(None, "a@b.c"), (7, "a@b.c"), (7, "a@b.c")]
    got = pii.sanitised(table(spark, rows)).select("doc_id", pii.span_text(F.col("base")))
    assert Counter(map(tuple, got.collect())) == Counter((i, plain_spans(t)) for i, t in rows)


def test_terms_that_give_an_entity_away(spark):
    random.seed(8)
    common = [f"common{i}" for i in range(30)]
    text = lambda: " ".join(random.choice(common) for _ in range(30))
    rows = [(i, f"{text()} Zanzibar, reach a.b@c.org now {i} {text()} zanzibar") for i in range(4)]
    rows += [(10 + i, f"{text()} tangier reach d.e@f.org {i}") for i in range(4)] + [(20, "tangier alone")]
    rows += [(100 + i, text()) for i in range(300)]
    rows += [(500 + i, f"copies only {text()}") for i in range(2)]
    copy = f"{text()} quixotic 10.1.2.3"
    rows += [(600 + i, copy) for i in range(50)]
    got = {r["doc_id"]: r for r in pii.sanitised(table(spark, rows)).collect()}
    spans = lambda i: [s["value"].lower() for s in got[i]["spans"] if s["kind"] == "term"]
    # "reach" stands beside one of the two only, which leaves little to guess.
    assert spans(0) == ["zanzibar", "reach", "zanzibar"] and spans(10) == ["tangier", "reach"]
    assert "Zanzibar" not in got[0]["redacted"] and "[EMAIL]" in got[0]["redacted"]
    assert "[TERM]" in got[10]["redacted"] and got[20]["redacted"] is None
    assert spans(600) == [] and got[600]["redacted"].endswith("quixotic [IP]")


def test_common_terms_are_counted_in_all_texts(spark):
    """`reach` stands beside both entities, but nothing else decides: its count over the corpus does."""
    rows = [(i, f"unusual word{i} a@b.org x{i}") for i in range(3)] + [(9 + i, f"filler{i} unusual") for i in range(400)]
    got = pii.sanitised(table(spark, rows)).where("size(spans) > size(base)")
    assert got.count() == 0


def test_personal_data_of_empty_tables(spark):
    assert pii.sanitised(table(spark, [(1, "a")]).limit(0)).count() == 0
    assert pii.sanitised(table(spark, [(1, None)])).count() == 1


# --- licences ---------------------------------------------------------------------------------


def test_templates_are_found_and_told_apart(spark):
    rows = [(i, f"Some text before. {t}\nand after, it goes on") for i, (*_, t) in enumerate(license_scan.TEMPLATES)]
    got = license_scan.licenses(table(spark, rows)).collect()
    named = {r["doc_id"]: r["license"] for r in got}
    assert named == {i: name for i, (name, *_) in enumerate(license_scan.TEMPLATES)}
    for r in got:
        assert rows[r["doc_id"]][1][r["start"] : r["end"]] == r["block"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []),
        ("", []),
        ("The licence plate was blue. A driving license, version 2.0, is required.", []),
        ("Licensed under the Apache License, Version 1.1.", []),
        ("Licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("released under the mit license", ["MIT"]),
        ("Copyright 2020 A. All rights reserved. Released under the MIT License.", ["Proprietary", "MIT"]),
        ("É " * 50 + "Licensed under CC BY-NC 4.0. " + "é " * 20_000, ["CC-BY-NC-4.0"]),
        ("Licensed under CC BY-SA 4.0.\nLicensed under CC BY-ND 4.0.", ["CC-BY-SA-4.0", "CC-BY-ND-4.0"]),
    ],
)
def test_wordings(spark, text, want):
    got = license_scan.licenses(table(spark, [(1, text), (1, text), (None, text)])).collect()
    assert Counter((r["doc_id"], r["license"]) for r in got) == Counter((i, w) for i in (1, 1, None) for w in want)


def test_statements_inside_longer_sentences(spark):
    """Word for word among other words, before and after, without a mark that ends the sentence."""
    once = {name: t for name, _, t in reversed(license_scan.TEMPLATES) if len(t) < 90 and "SPDX" not in t}
    prose = "the code in this repository and the pages beside it were written over many years by several people and "
    rows = [(name, f"{prose * n}{t.rstrip('.')} {prose * n}") for name, t in once.items() for n in (1, 20)]
    rows += [("none", f"this {prose * 3} work {prose} is in the museum of public art and has a domain license {prose}")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = Counter((r["doc_id"], r["license"]) for r in license_scan.licenses(docs).collect())
    assert got == Counter({(name, name): 2 for name in once})


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0"]),
        ("// SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1"]),
        ("SPDX-License-Identifier: BSD-3-Clause", ["BSD-3-Clause"]),
        ("SPDX-License-Identifier: ISC", ["ISC"]),
        ("It is licensed under the GNU General Public License v3.0.", ["GPL-3.0"]),
        ("Available under CC BY 4.0", ["CC-BY-4.0"]),
        ("Licensed under the Eclipse Public License, version 2.0.", ["EPL-2.0"]),
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version.",
            ["GPL-3.0"],
        ),
        (
            "It is licensed under the Apache License, Version 2.0 or released under the MIT License at your option",
            ["Apache-2.0", "MIT"],
        ),
        ("It is licensed under the GPLv3", ["GPL-3.0"]),
        ("licensed under the LGPLv2.1 by us", ["LGPL-2.1"]),
        ("Licensed under the BSD 3-Clause License", ["BSD-3-Clause"]),
        ("Licensed under the BSD 2-Clause License.", ["BSD-2-Clause"]),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
        ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", ["CC-BY-NC-SA-4.0"]),
    ],
)
def test_further_notices(spark, text, want):
    got = license_scan.licenses(table(spark, [(1, text)])).collect()
    assert [r["license"] for r in got] == want
    assert all(text[r["start"] : r["end"]] == r["block"] for r in got)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Dual licensed: MIT or Apache-2.0", {"MIT", "Apache-2.0"}),
        ("Dual licensed: Apache-2.0 or MIT.", {"MIT", "Apache-2.0"}),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", {"MIT", "Apache-2.0"}),
        ("SPDX-License-Identifier: GPL-2.0-only OR MIT", {"GPL-2.0", "MIT"}),
        ("SPDX-License-Identifier: MIT AND BSD-3-Clause AND ISC", {"MIT", "BSD-3-Clause", "ISC"}),
        ("This is not licensed under the MIT License.", set()),
        ("It is never released under the MIT License.", set()),
        ("Licensed, but not under the Apache License, Version 2.0.", set()),
        ("It is not only released under the MIT License.", {"MIT"}),
        ("This is not Licensed under the GPLv3", set()),
        ("You may not use it otherwise. Released under the MIT License.", {"MIT"}),
    ],
)
def test_expressions_and_denials(text, want):
    assert {f.license for f in license_scan.Scanner().scan(text)} == want


def brute_force(text):
    """All templates against all stretches of each sentence: the licences of those that bear one out, the longest first."""
    found = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text):
        there = license_scan.words(sentence)
        scanner = license_scan.Scanner()
        for name, naming, own, _ in scanner.known:
            for i in range(len(there)):
                for j in range(i + 1, min(len(there), i + 2 * len(own)) + 1):
                    if not set(naming) - set(there[i:j]):
                        told = scanner._aligned(there[i:j], naming, own)
                        denied = set(there[max(0, i - 2) : i]) & license_scan.DENIALS and len(own) < 20
                        if told and not denied:
                            found.append((len(own) - len(told[3]), name, sentence, i + told[0], i + told[1]))
    kept = []
    for matched, name, sentence, first, last in sorted(found, key=lambda f: (-f[0], f[4] - f[3], f[3])):
        if all(s != sentence or last <= x or y <= first for _, s, x, y in kept):
            kept.append((name, sentence, first, last))
    return {name for name, *_ in kept}


def test_licenses_against_all_templates_and_stretches():
    rng = random.Random(8)
    statements = [t for *_, t in license_scan.TEMPLATES if len(t) < 120 and "Dual" not in t]
    filler = "the code here and its pages are by many people who share it with a license of the kind one reads".split()
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 3)):
            words = rng.choice(statements).rstrip(".").split()
            if rng.random() < 0.4:
                words.pop(rng.randrange(len(words)))
            if rng.random() < 0.4:
                words.insert(rng.randrange(len(words)), rng.choice(filler))
            around = [rng.choice(filler) for _ in range(rng.randrange(8))]
            parts.append(" ".join(around[:3] + words + around[3:]) + ".")
        texts.append("\n".join(parts))
    scanner = license_scan.Scanner()
    got = [{f.license for f in scanner.scan(t)} for t in texts]
    want = [brute_force(t) for t in texts]
    assert sum(map(bool, want)) > 15
    assert [(t, g, w) for t, g, w in zip(texts, got, want, strict=True) if g != w] == []


def test_licenses_of_an_empty_table(spark):
    assert license_scan.licenses(table(spark, [(1, "a")]).limit(0)).count() == 0


# --- language ---------------------------------------------------------------------------------

SAMPLES = {
    "en": "the cat and the dog went with their friends to this house that is there",
    "de": "der hund und die katze gingen mit ihren freunden zu dem haus das dort ist",
    "fr": "le chien et le chat sont avec leurs amis dans cette maison qui est là",
    "es": "el perro y el gato fueron con sus amigos a esta casa que está allí",
}


def language_rows(n=80):
    random.seed(12)
    rows = []
    for i in range(4 * n):
        lang = list(SAMPLES)[i % 4]
        words = SAMPLES[lang].split()
        rows.append((i, " ".join(random.choice(words) for _ in range(25)), lang))
    return rows


def test_held_out_languages(spark):
    import zlib

    docs = spark.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    told = langid.predictions(docs, F.col("text"), langid.fit(docs)).select("*", langid.held_out(F.col("doc_id")).alias("h"))
    rows = told.collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["h"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(i, t, x if not __import__("zlib").crc32(str(i).encode()) % 4 == 2 else "xx") for i, t, x in language_rows(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert "xx" not in langid.fit(docs).languages


def test_copies_take_no_places_in_the_sample(spark, monkeypatch):
    """A language of 60 texts beside thousands of copies of one: its distinct texts are learned, each once."""
    rows = language_rows()
    rows += [(10_000 + i, "the same english text again and again", "en") for i in range(50_000)]
    learned = []
    monkeypatch.setattr(langid, "_train", lambda texts, labels: learned.append((texts.copy(), labels)))
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=40)
    texts, labels = learned[0]
    for lang in SAMPLES:
        own = [t.tobytes() for t in texts[labels == lang]]
        assert 30 <= len(own) <= 40 and len(set(own)) == len(own)


def test_held_out_documents_of_the_tables(spark):
    """Documents that are never learned from, of the largest of the tables."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(4)
    told = langid.predictions(docs, F.col("text"), langid.fit(docs)).where(langid.held_out(F.col("doc_id")))
    right = (F.col("lang") == F.col("lang_pred")).cast("int")
    few = (F.col("score") < langid.TOSS_UP).cast("int")
    found = told.where("lang is not null").agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("right"), F.avg(few).alias("few")).head()
    assert found["n"] > 2000 and found["right"] >= 0.997 and found["few"] <= 0.001


def test_texts_without_a_language(spark):
    docs = spark.createDataFrame(language_rows(30), "doc_id long, text string, lang string")
    model = langid.fit(docs)
    odd = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, "123 !?", "c"), (None, "und", "d"), (5, "the " * 300_000, "e")],
        "doc_id long, text string, lang_pred string",
    )
    got = {r["doc_id"]: r for r in langid.predictions(odd, F.col("text"), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[5]["lang_pred"] == "en"
    assert got[None]["lang_pred"] in SAMPLES and set(got[1].asDict()) == {"doc_id", "text", "lang_pred", "score"}
    assert langid.fit(docs.limit(0)) is None
    assert langid.predictions(odd, F.col("text"), None).where("lang_pred = 'und' and score = 0").count() == 5
    one = langid.fit(docs.where("lang = 'fr'"))
    assert one.predict("bonjour") == ("fr", 1.0)


# --- mixing -----------------------------------------------------------------------------------


def mixing_rows(n=600):
    random.seed(14)
    plain = [f"word{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(n):
        words = [random.choice(plain) for _ in range(random.choice([20, 60, 200]))]
        toxic, quality = int(i % 10 == 0), int(i % 4 > 0)
        if toxic:
            words[3] = words[9] = "vile"
        if not quality:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, quality, toxic))
    return rows, labels


def test_rates_meet_the_targets(spark):
    rows, labels = mixing_rows()
    labels = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    targets = {"clean": 0.7, "poor": 0.28, "toxic": 0.02}
    got = mixing.rates(table(spark, rows + [(9000, None), (9001, "")]), labels, targets).collect()
    total = sum(r["rate"] * r["tokens"] for r in got)
    for domain, share in targets.items():
        assert abs(sum(r["rate"] * r["tokens"] * r[f"p_{domain}"] for r in got) / total - share) < 1e-5
    assert all(r["rate"] >= 0 and abs(r["copies"] - r["rate"]) < 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["tokens"] == len((t or "").split()) for i, t in rows)
    right = sum(by_id[i]["domain"] == ("toxic" if i % 10 == 0 else "clean" if i % 4 else "poor") for i, _ in rows)
    assert right >= 0.95 * len(rows)


def test_steps_reach_a_least_squares_solution(spark):
    """Against a plain solver, with targets that push rates to zero."""
    import numpy as np

    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    tokens = rng.integers(1, 500, 300)
    weighted = spark.createDataFrame(
        [(int(t), [float(x) for x in q]) for t, q in zip(tokens, p, strict=True)], "__tokens long, __p array<double>"
    )
    steps = mixing.fit_rates(weighted, {"clean": 0.9, "poor": 0.08, "toxic": 0.02})
    rate = np.ones(300)
    for step in steps:
        rate = np.maximum(0, rate - p @ np.array(step))
    totals = (rate * tokens) @ p
    assert (rate == 0).any() and np.allclose(totals / totals.sum(), [0.9, 0.08, 0.02], atol=1e-5)


def test_the_least_residual_is_kept_and_reported(spark, caplog):
    """Targets out of reach: the steps end at the least residual of all on the way, and this is logged."""
    import numpy as np

    rng = np.random.default_rng(3)
    p = np.concatenate([rng.dirichlet([8, 4, 1], 150), rng.dirichlet([4, 8, 2], 150)])
    tokens = rng.integers(1, 500, 300)
    weighted = spark.createDataFrame(
        [(int(t), [float(x) for x in q]) for t, q in zip(tokens, p, strict=True)], "__tokens long, __p array<double>"
    )
    with caplog.at_level("WARNING", logger="orderloom.llm.mixing"):
        steps = mixing.fit_rates(weighted, {"clean": 0.98, "poor": 0.0, "toxic": 0.02})
    total = tokens @ p
    goal = np.array([total[0], 0.0, min(total[2], total[0] * 0.02 / 0.98)])
    unwanted = p[:, 2] > 0.5
    rate, off = np.ones(300), [np.linalg.norm(total - goal)]
    for step in steps:
        rate = np.maximum(0, rate - p @ np.array(step))
        rate[unwanted] = np.minimum(rate[unwanted], 1)
        off.append(np.linalg.norm((rate * tokens) @ p - goal))
    assert len(steps) > 1 and min(off) == off[-1]
    assert f"{off[-1] / goal.sum():.3g}" in caplog.text


def test_few_toxic_documents_are_not_repeated(spark):
    rows, labels = mixing_rows(1000)
    rows = [r for r in rows if r[0] % 10 or r[0] % 50 == 0]
    docs, labels = table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = mixing.rates(docs, labels).collect()
    toxic = [r for r in got if r["doc_id"] % 10 == 0]
    assert len(toxic) == 20 and all(r["domain"] == "toxic" and r["rate"] <= 1 and r["copies"] <= 1 for r in toxic)
    mean = sum(r["rate"] for r in got) / len(got)
    assert 0.5 < mean < 1.5 and max(r["rate"] for r in got) < 3


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_that_share_an_id_are_rounded_each(spark, shared):
    """A third of the rows have no id, or the same: the copies make the totals that the rates make."""
    rows, labels = mixing_rows(1500)
    rows = [(shared if i % 3 == 2 else i, t) for i, t in rows]
    labels = [x for x in labels if x[0] % 3 != 2 and x[0] != shared]
    docs, labels = table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    targets = {"clean": 0.6, "poor": 0.38, "toxic": 0.02}
    for own in (True, False):
        got = [r for r in mixing.rates(docs, labels, targets).collect() if (r["doc_id"] == shared) != own]
        for domain in ("clean", "poor", "toxic"):
            there = [r for r in got if r["domain"] == domain]
            want = sum(r["rate"] for r in there)
            assert len(there) > 30 and abs(sum(r["copies"] for r in there) - want) < 4 * (0.25 * len(there)) ** 0.5
    kept = sum(r["copies"] for r in mixing.rates(docs, labels, targets).collect())
    assert abs(mixing.mixed(docs, labels, targets).count() - kept) < 4 * (0.25 * len(rows)) ** 0.5


def test_mixed_documents(spark):
    rows, labels = mixing_rows(200)
    docs = table(spark, rows + [(5000, None)])
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    mixed = mixing.mixed(docs, labels)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.rates(docs, labels).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})
    assert mixing.mixed(docs.limit(0), labels).count() == 0
    assert mixing.rates(docs, labels.limit(0)).where("rate <> 1 or copies <> 1").count() == 0


# --- shards -----------------------------------------------------------------------------------


def test_table_is_filled_in_turns():
    names = sharding.shard_names(7)
    owners = sharding.fill(names, 101)
    free, want = set(range(101)), {}
    turn = 0
    while free:
        name = names[turn % 7]
        at = int(hashlib.md5(f"{name}/offset".encode()).hexdigest()[:15], 16) % 101
        step = int(hashlib.md5(f"{name}/stride".encode()).hexdigest()[:15], 16) % 100 + 1
        slot = next(s for s in ((at + j * step) % 101 for j in range(101)) if s in free)
        free.remove(slot)
        want[slot] = turn % 7
        turn += 1
    assert owners == [want[s] for s in range(101)]
    sizes = Counter(owners).values()
    assert max(sizes) - min(sizes) <= 1


def test_a_new_shard_moves_few_slots():
    before, after = sharding.fill(sharding.shard_names(20)), sharding.fill(sharding.shard_names(21))
    assert sum(a != b for a, b in zip(before, after, strict=True)) < 0.15 * len(before)


@pytest.mark.parametrize("slots", [0, 4, 100, 5])
def test_sizes_that_do_not_do(slots):
    with pytest.raises(ValueError):
        sharding.fill(sharding.shard_names(7), slots)


def test_placement(spark):
    rows = [(i, "x", 9) for i in range(3000)] + [(5, "y", 9), (None, "z", 9), (None, "z", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    placed = sharding.place(docs, sharding.shard_names(8), 101)
    assert placed.columns == ["doc_id", "text", "slot", "shard"] and placed.count() == len(rows)
    owners = sharding.fill(sharding.shard_names(8), 101)
    for r in placed.collect():
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["slot"] == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert r["shard"] == owners[r["slot"]]
    assert sharding.place(docs.limit(0)).count() == 0
