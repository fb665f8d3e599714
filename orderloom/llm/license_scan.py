"""Licence statements by conditional compression.

A block of text that restates a licence hardly needs any bytes once the licence is known. Each candidate block (a
sentence with a word that licences use, and a paragraph that has several) is compressed with zstandard by
itself and with each template as raw dictionary whose naming words it holds. Templates are ranked by the bytes saved; the
first in rank whose wording bears it out wins its place, however long the block, and others beside it stay: the words of the template and of a stretch
of its length around a naming word are aligned, the template has to be covered, and its naming words, such as a
version, must all be there with no word put between them that would make it another licence, and no word that denies it.
Licences that are joined to one that is found, by their short names and "or" or "and", are findings too. The differences
are returned along with the finding.

Spark finds the texts that hold such a word at all; only these reach Python, each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import picked, ship

LEVEL = 3
COVERED = 0.75
# A version written on to a short name, as in GPLv3, is a word by itself.
WORD = re.compile(r"(?:[al]?gpl|mpl|epl)(?=v?[0-9])|[a-z0-9]+(?:\.[0-9]+)*", re.IGNORECASE | re.ASCII)
# Words that licences use, fixed values; SPDX marks among them.
TRIGGERS = [
    "licen[cs]",
    "copyright",
    "rights reserved",
    "public domain",
    "spdx",
    "permission is hereby granted",
    "redistribution and use",
    "without warrant",
    "creative commons",
    # What names a licence without any of these.
    r"\bcc[ -]by\b",
    r"\bcc0\b",
    r"general public",
    r"\b[al]?gpl(?:v?[0-9]|\b)",
    r"\bapache\b",
    r"mozilla public",
    r"eclipse public",
    r"\bunder the (?:mit|bsd|isc)\b",
    r"\bdual[ -]licen[cs]ed\b",
    r"unencumbered",
]
TRIGGER = re.compile("|".join(TRIGGERS), re.IGNORECASE)
BLANK_LINE = re.compile(r"(\n[ \t\r]*\n)")
# A version is told by its number: v3, v3.0 and 3.0 are 3.
VERSION = re.compile(r"v?([0-9]+(?:\.[0-9]+)*?)(?:\.0)*")
# "v. 2.0" does not end a sentence.
SENTENCE_END = re.compile(r"(?<!\bv)[.!?](?=\s|$)|\n")
SENTENCE_MARKS = (". ", "! ", "? ", "\n")

# Words that make a statement its opposite, and words that join licences of which one may choose.
DENIALS = {"not", "never", "neither", "nor", "isn", "cannot"}
JOINTS = {"or", "and"}
# Licences by the words of their short names, fixed values: what may stand beside a licence that is found.
SHORT_NAMES = {
    "MIT": "mit", "ISC": "isc", "Apache-2.0": "apache 2.0", "MPL-2.0": "mpl 2.0", "EPL-2.0": "epl 2.0",
    "GPL-2.0": "gpl 2.0", "GPL-3.0": "gpl 3.0", "LGPL-2.1": "lgpl 2.1", "LGPL-3.0": "lgpl 3.0", "AGPL-3.0": "agpl 3.0",
    "BSD-2-Clause": "bsd 2 clause", "BSD-3-Clause": "bsd 3 clause", "CC0-1.0": "cc0 1.0", "CC-BY-4.0": "cc by 4.0",
    "CC-BY-SA-4.0": "cc by sa 4.0",
}
# Templates, fixed values: licence, naming words, text of a statement or notice.
TEMPLATES = [
    ("MIT", "mit", "Released under the MIT License."),
    ("MIT", "mit", "This project is licensed under the terms of the MIT license."),
    ("MIT", "mit", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "hereby granted merge publish distribute sublicense sell",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        "apache 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "gnu general public 3", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "gpl 3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "gnu general public 2", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "gnu lesser general public 3", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "gnu affero general public 3", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "mozilla public 2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    (
        "MPL-2.0",
        "mozilla public 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "BSD",
        "redistribution source binary forms permitted",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "ISC",
        "permission use copy modify fee hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "cc by 4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by sa 4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "cc by nc 4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "cc by nc sa 4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "cc by nd 4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "cc0 1.0 universal", "Licensed under Creative Commons CC0 1.0 Universal."),
    ("Unlicense", "released public domain", "This is free and unencumbered software released into the public domain."),
    ("GPL-3.0", "gnu general public 3", "Licensed under the GNU General Public License v3.0."),
    ("GPL-2.0", "gnu general public 2", "Licensed under the GNU General Public License v2.0."),
    *[
        (name, naming, f"SPDX-License-Identifier: {name}{suffix}")
        for name, naming, suffix in [
            ("GPL-2.0", "identifier gpl 2.0", "-only"),
            ("LGPL-2.1", "identifier lgpl 2.1", "-only"),
            ("LGPL-3.0", "identifier lgpl 3.0", "-only"),
            ("AGPL-3.0", "identifier agpl 3.0", "-only"),
            ("MPL-2.0", "identifier mpl 2.0", ""),
            ("EPL-2.0", "identifier epl 2.0", ""),
            ("BSD-2-Clause", "identifier bsd 2 clause", ""),
            ("BSD-3-Clause", "identifier bsd 3 clause", ""),
            ("ISC", "identifier isc", ""),
        ]
    ],
    *[
        (
            f"{short}-{version}",
            f"redistribute modify gnu {kind}general public {version}",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            f"{kind}General Public License as published by the Free Software Foundation, either version {version} of the "
            "License, or (at your option) any later version.",
        )
        for short, kind, version in [
            ("GPL", "", "2.0"),
            ("GPL", "", "3.0"),
            ("LGPL", "Lesser ", "2.1"),
            ("LGPL", "Lesser ", "3.0"),
            ("AGPL", "Affero ", "3.0"),
        ]
    ],
    ("LGPL-2.1", "gnu lesser general public 2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("EPL-2.0", "eclipse public 2.0", "Licensed under the Eclipse Public License, version 2.0."),
    *[
        (name, naming, f"Licensed under the {written}.")
        for name, naming, written in [
            ("GPL-2.0", "gpl 2", "GPLv2"),
            ("GPL-3.0", "gpl 3", "GPLv3"),
            ("LGPL-2.1", "lgpl 2.1", "LGPLv2.1"),
            ("LGPL-3.0", "lgpl 3", "LGPLv3"),
            ("AGPL-3.0", "agpl 3", "AGPLv3"),
            ("BSD-2-Clause", "bsd 2 clause", "BSD 2-Clause License"),
            ("BSD-3-Clause", "bsd 3 clause", "BSD 3-Clause License"),
        ]
    ],
    *[
        (
            f"CC-BY{short}-4.0",
            f"creative commons attribution {naming} 4.0",
            f"Creative Commons Attribution{written} 4.0 International License.",
        )
        for short, naming, written in [
            ("", "", ""),
            ("-SA", "sharealike", "-ShareAlike"),
            ("-NC", "noncommercial", "-NonCommercial"),
            ("-NC-SA", "noncommercial sharealike", "-NonCommercial-ShareAlike"),
            ("-ND", "noderivatives", "-NoDerivatives"),
        ]
    ],
    ("MIT", "dual licensed mit", "Dual licensed: MIT."),
    ("Apache-2.0", "dual licensed apache 2.0", "Dual licensed: Apache-2.0."),
    ("Public-Domain", "public domain", "This work is in the public domain."),
    ("Proprietary", "all rights reserved", "All rights reserved."),
]


@dataclass(frozen=True)
class Finding:
    start: int
    end: int
    license: str
    saved: float
    covered: float
    missing: list[str]
    extra: list[str]
    block: str
    matched: int
    part: bool


def words(text: str) -> list[str]:
    found = [w.lower() for w in WORD.findall(text)]
    return [v[1] if (v := VERSION.fullmatch(w)) else w for w in found]


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Places of sentences with a trigger, and of paragraphs with several."""
    at = 0
    for paragraph in BLANK_LINE.split(text):
        found = list(TRIGGER.finditer(paragraph))
        end = 0
        for hit in found:
            if hit.start() < end:
                continue
            opened = [paragraph.rfind(mark, end, hit.start()) + len(mark) for mark in SENTENCE_MARKS]
            start = max([end, *(place for place, mark in zip(opened, SENTENCE_MARKS, strict=True) if place >= len(mark))])
            stop = SENTENCE_END.search(paragraph, hit.end())
            end = len(paragraph) if stop is None else stop.start() + (stop[0] != "\n")
            yield at + start, at + end
        if len(found) > 1:
            yield at + paragraph.rfind("\n", 0, found[0].start()) + 1, at + len(paragraph)
        at += len(paragraph)


def _denied(there: list[str], first: int, last: int, extra: list[str]) -> bool:
    """Whether a short statement is denied, within it or by one of the two words before it; "not only" denies nothing."""
    near = there[max(0, first - 2) : first] + extra
    return any(w in DENIALS and "only" not in there[max(0, first - 2) : last] for w in near)


def beside(there: list[str], first: int, last: int) -> list[tuple[int, int, str]]:
    """Words and licence of the short names joined, by "or" or "and", to one within or at the end of a stretch."""
    names = []
    for name, short in SHORT_NAMES.items():
        own = words(short)
        names += [(i, i + len(own), name) for i in range(len(there) - len(own) + 1) if there[i : i + len(own)] == own]
    # Of names that begin at a place, the longest one; "only" and "later" may follow a version.
    longest = {i: (i, j, n) for i, j, n in sorted(names, key=lambda x: x[1])}
    names = sorted(longest.values())
    chain = [k for k, (i, j, _) in enumerate(names) if first <= i and j <= last]
    reached = set(chain)
    for k in chain:
        for step in (1, -1):
            at = k
            while 0 <= at + step < len(names):
                left, right = sorted((names[at], names[at + step]))
                gap = [w for w in there[left[1] : right[0]] if w not in ("only", "later")]
                if right[0] < left[1] or not gap or set(gap) - JOINTS:
                    break
                at += step
                reached.add(at)
    joined = len(reached) > 1
    return [names[k] for k in sorted(reached)] if joined else []


class Scanner:
    """Compressors of a task, one per template."""

    def __init__(self, templates=TEMPLATES, covered: float = COVERED):
        self.covered = covered
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
        self.known = []
        for name, naming, text in templates:
            raw = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            packer = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=raw, write_checksum=False, write_content_size=False
            )
            self.known.append((name, words(naming), words(text), packer))

    def ranked(self, block: str, there: set[str]) -> list[tuple[float, int]]:
        """Share of bytes saved and number of the templates whose naming words are there, the largest share first."""
        named = [i for i, (_, naming, *_) in enumerate(self.known) if there.issuperset(naming)]
        if not named:
            return []
        data = block.lower().encode(errors="replace")
        alone = len(self.plain.compress(data))
        shares = [(1 - len(self.known[i][3].compress(data)) / alone, i) for i in named]
        return sorted(shares, key=lambda x: (-x[0], x[1]))

    def compared(self, there: list[str], template: int) -> list[tuple[int, int, float, list[str], list[str]]]:
        """For each stretch of the block that bears the template out, the one that covers most first: its words,
        coverage of the template, its words that are missing and words put in."""
        _, naming, own, _ = self.known[template]
        places = {w: [i for i, x in enumerate(there) if x == w] for w in set(naming)}
        anchor = min(naming, key=lambda w: len(places[w]))
        before, slack = own.index(anchor), 2 + len(own) // (4 if len(own) < 20 else 1)
        after = len(own) - own[::-1].index(anchor) - before
        found = []
        for i in places[anchor]:
            start = max(0, i - before - after - slack)
            told = self._aligned(there[start : i + len(own) - before + slack], naming, own)
            if told:
                found.append((start + told[0], start + told[1], *told[2:]))
        return sorted(found, key=lambda f: (-f[2], len(f[4]), f[0]))

    def _aligned(self, there: list[str], naming: list[str], own: list[str]):
        same = [m for m in SequenceMatcher(None, there, own, autojunk=False).get_matching_blocks() if m.size]
        if not same:
            return None
        matched = {m.b + k for m in same for k in range(m.size)}
        first, last = same[0].a, same[-1].a + same[-1].size
        held = {m.a + k for m in same for k in range(m.size)}
        missing = [w for k, w in enumerate(own) if k not in matched]
        extra = [there[k] for k in range(first, last) if k not in held]
        covered = len(matched) / len(own)
        names = [k for k in range(first, last) if k in held and there[k] in naming]
        between = [k for k in range(names[0], names[-1]) if k not in held] if names else []
        # A list of licences may stand between: other names and what joins them.
        listed = {w for name in SHORT_NAMES.values() for w in words(name)} | JOINTS
        between = [k for k in between if not ("dual" in naming and there[k] in listed)]
        if covered < self.covered or set(naming) & set(missing) or (between and len(own) < 20):
            return None
        if len(own) < 20 and _denied(there, first, last, extra):
            return None
        return first, last, covered, missing, extra

    def scan(self, text: str) -> list[Finding]:
        found = []
        for start, end in blocks(text):
            block = text[start:end]
            there, own_found = words(block), []
            for saved, template in self.ranked(block, set(there)):
                for first, last, *told in self.compared(there, template):
                    if all(last <= x or y <= first for x, y, *_ in own_found):
                        own_found.append((first, last, template, saved, told))
            known = {self.known[t][0] for _, _, t, *_ in own_found}
            for k, (first, last, template, saved, told) in enumerate(list(own_found)):
                joined = beside(there, first, last)
                for x, y, name in joined:
                    if name == self.known[template][0] and any(first <= i and j <= last for i, j, n in joined if n != name):
                        own_found[k] = (x, y, template, saved, told)  # the others stand within the statement
                    elif name not in known:
                        known.add(name)
                        number = next(i for i, (n, *_) in enumerate(self.known) if n == name)
                        own_found.append((x, y, number, saved, [1.0, [], []]))
            # A block with one licence is its finding; of several, each is where its wording stands.
            part = len(own_found) > 1
            places = [m.span() for m in WORD.finditer(block)] if part else []
            for first, last, template, saved, told in own_found:
                name, _, own, _ = self.known[template]
                x, y = (start + places[first][0], start + places[last - 1][1]) if part else (start, end)
                found.append(Finding(x, y, name, saved, *told, text[x:y], len(own) - len(told[1]), part))
        # Of findings that overlap, the one with more of its template stays, then a whole block, then the shorter one.
        kept: list[Finding] = []
        for one in sorted(found, key=lambda f: (-f.matched, f.part, f.end - f.start, f.start)):
            if all(one.end <= k.start or k.end <= one.start for k in kept):
                kept.append(one)
        return sorted(kept, key=lambda f: f.start)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        ids, found = [], []
        for i, text in enumerate(batch.column("text")):
            own = scanner.scan(text.as_py())
            ids += [i] * len(own)
            found += own
        columns = ("start", "end", "license", "saved", "covered", "missing", "extra", "block")
        number, share, text = pa.int64(), pa.float64(), pa.string()
        kinds = (number, number, text, share, share, pa.list_(text), pa.list_(text), text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(ids, pa.int64())),
                *[pa.array([getattr(f, c) for f in found], k) for c, k in zip(columns, kinds, strict=True)],
            ],
            names=["doc_id", *columns],
        )


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per finding: doc_id, start, end (code points), license, saved, covered, missing, extra, block.

    Findings of a text don't overlap. A text without a finding, a null or an empty one has no row. Each row of
    the table is scanned for itself, so repeated rows and null ids have their findings as often.
    """
    ship(docs.sparkSession)
    plain = picked(docs, doc_id=id_col, text=text_col)
    likely = plain.where(F.col("text").rlike("(?i)" + "|".join(TRIGGERS)))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    return likely.mapInArrow(
        _scanned,
        f"doc_id {id_type}, start long, end long, license string, saved double, covered double, "
        "missing array<string>, extra array<string>, block string",
    )
