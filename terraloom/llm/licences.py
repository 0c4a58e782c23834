"""Licence scans by Dice coefficient over word bigrams (operator 2)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?;])\s+")
#: Spellings that count as one.
VARIANTS: dict[str, str] = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorisation": "authorization",
    "authorised": "authorized",
    "favour": "favor",
    "fulfil": "fulfill",
    "judgement": "judgment",
    "labelled": "labeled",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "modelled": "modeled",
    "organisation": "organization",
    "organisations": "organizations",
    "programme": "program",
    "recognise": "recognize",
    "sublicence": "sublicense",
    "unauthorised": "unauthorized",
    "utilisation": "utilization",
}
_STEMS = tuple(sorted({k[:6] for k in VARIANTS}))
_VARIANT = re.compile(rf"\b(?:{'|'.join(sorted(VARIANTS, key=len, reverse=True))})\b")
# what begins a line and says nothing: marks of comments and of lists, and then a copyright statement with the line it takes
_LEAD = re.compile(r"^[ \t]*(?:[*#/;%>|\u2022-]+[ \t]*)*(?:\(?(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})[.)][ \t]+)?(?:(?:copyright\b[ \t]*(?:\(c\)|\xa9|[0-9<\[{])|\(c\)[ \t]*[0-9<\[{]|\xa9)[^\n]*)?", re.M)
_RIGHTS = re.compile(r"^[ \t]*all rights reserved\.?[ \t]*$", re.M)


def normalised(text: str) -> str:
    """Lower case, spellings made one, without copyright statements and the marks of comments and lists at line starts. Lines stay in place."""
    low = text.lower()
    if any(stem in low for stem in _STEMS):
        low = _VARIANT.sub(lambda m: VARIANTS[m[0]], low)
    low = _LEAD.sub("", low)
    return _RIGHTS.sub("", low) if "all rights reserved" in low else low


#: Short notices by which works name their licence, by SPDX identifier. Callers may give templates of their own.
NOTICES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "Licensed under the GNU AGPL, version 3."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    "0BSD": ("Released under the Zero-Clause BSD License.",),
    "Artistic-2.0": ("Released under the Artistic License 2.0.",),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "Licensed under the Simplified BSD License."),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "Licensed under the New BSD License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0 Universal.", "This work has been dedicated to the public domain under CC0 1.0."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU GPL, version 2."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL, version 3."),
    "ISC": ("Released under the ISC License.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "MPL-2.0": ("Released under the Mozilla Public License, version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "PSF-2.0": ("Released under the Python Software Foundation License Version 2.",),
    "Zlib": ("Released under the zlib License.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    """Word bigrams of a normalised text (letters and digits); a single word stands with an empty partner."""
    words = _WORD.findall(text)
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset((w, "") for w in words)


def full_texts() -> dict[str, tuple[str, ...]]:
    """Licence bodies and file headers by SPDX identifier, from the package's ``licence_texts``."""
    texts: dict[str, tuple[str, ...]] = {}
    for f in sorted(files("terraloom.llm").joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        name = f.name.removesuffix(".txt").removesuffix("-header")
        texts[name] = (*texts.get(name, ()), f.read_text(encoding="utf-8"))
    return texts


class Templates:
    def __init__(self, templates: dict[str, tuple[str, ...]], least: float):
        self.sets = [(name, bigrams(normalised(t))) for name, texts in sorted(templates.items()) for t in texts]
        self.least, self.holders = least, {}
        for i, (_, grams) in enumerate(self.sets):
            for g in grams:
                self.holders.setdefault(g, []).append(i)
        sizes = [len(g) for _, g in self.sets]
        # Dice of at least t allows sizes that differ by (2 - t) / t at most
        self.ratio = (2 - least) / least
        self.low, self.high = min(sizes, default=1) / self.ratio, max(sizes, default=0) * self.ratio
        self.single = any(not g[1] for g in self.holders)

    def best(self, text: str) -> tuple[float, str] | None:
        """The likest template for a normalised text within the size bounds, if it reaches the limit; of equals, the first by name."""
        grams = bigrams(text)
        n = len(grams)
        if not self.low <= n <= self.high:
            return None
        shared = Counter(i for g in grams if g in self.holders for i in self.holders[g])
        found = [(2 * k / (n + len(self.sets[i][1])), self.sets[i][0]) for i, k in shared.items() if n <= self.ratio * len(self.sets[i][1]) and len(self.sets[i][1]) <= self.ratio * n]
        return min(((-d, name) for d, name in found if d >= self.least), default=None)

    def likely(self, words: list[str]) -> list[int]:
        """Templates of which the text holds so many distinct bigrams that some part of it may reach the limit."""
        grams = set(zip(words, words[1:]))
        if self.single:
            grams |= {(w, "") for w in words}
        shared = Counter(i for g in grams & self.holders.keys() for i in self.holders[g])
        return [i for i, k in shared.items() if k * self.ratio >= len(self.sets[i][1]) - 1e-9]

    def windows(self, pairs: list[tuple[str, str]], i: int) -> Iterator[tuple[int, int, int, float]]:
        """Runs of bigrams (first, last, shared, dice) that reach the limit, anywhere in the text and of any length.

        A run of n distinct bigrams sharing k with a template of m has Dice t where 2 k - t n = t m, so a distinct shared bigram weighs 2 - t and
        another one -t: the heaviest runs are found in one pass, then both ends are set anew.
        """
        t, grams = self.least, self.sets[i][1]
        m = len(grams)

        def heaviest(order: range) -> tuple[float, int, int, int]:
            seen, total, top = set(), 0.0, (0.0, order[0], 0, 0)
            k = 0
            for p in order:
                if pairs[p] not in seen:
                    seen.add(pairs[p])
                    hit = pairs[p] in grams
                    k += hit
                    total += 2 - t if hit else -t
                    if hit and total > top[0]:
                        top = (total, p, k, len(seen))
            return top

        start = 0
        while start < len(pairs):
            seen, total, top, first, last, p = set(), 0.0, 0.0, -1, -1, start
            while p < len(pairs):
                g = pairs[p]
                if g not in seen:
                    if g in grams:
                        first = p if first < 0 else first
                        seen.add(g)
                        total += 2 - t
                        if total > top:
                            top, last = total, p
                    elif first >= 0:
                        seen.add(g)
                        total -= t
                        if total < 0:
                            break
                if top >= t * m - 1e-9 and p - last > 2 * m:
                    break
                p += 1
            if first < 0:
                return
            low = heaviest(range(last, first - 1, -1))[1]
            _, end, k, n = heaviest(range(low, min(p + 1, len(pairs))))
            if k and 2 * k / (n + m) >= t:
                yield low, end, k, 2 * k / (n + m)
                start = max(end, last) + 1
            else:
                start = p + 1

    def scan(self, text: str) -> list[dict]:
        """Licences of the whole text, of its lines, of the sentences of lines that are none themselves, and of runs of words elsewhere."""
        text = normalised(text)
        words = _WORD.findall(text)
        likely = self.likely(words)
        if not likely:
            return []
        out, line_of = [], []
        size = [0] * len(words)  # of the largest match over each word

        def take(line: int, name: str, dice: float, a: int, b: int) -> None:
            out.append({"line": line, "licence": name, "dice": dice})
            size[a:b] = [max(n, b - a) for n in size[a:b]]

        if hit := self.best(text):
            take(-1, hit[1], -hit[0], 0, len(words))
        for i, line in enumerate(text.split("\n")):
            at = len(line_of)
            line_of += [i] * len(_WORD.findall(line))
            if hit := self.best(line):
                take(i, hit[1], -hit[0], at, len(line_of))
            elif any(c in line for c in ".!?;"):
                for s in _SENTENCE.split(line):
                    n = len(_WORD.findall(s))
                    if hit := self.best(s):
                        take(i, hit[1], -hit[0], at, at + n)
                    at += n
        pairs = list(zip(words, words[1:]))
        found = sorted((-k, -d, self.sets[i][0], a, b + 2) for i in likely for a, b, k, d in self.windows(pairs, i))
        for _, d, name, a, b in found:
            # what a part of like or larger size covers already is told
            if max(size[a:b]) * self.ratio < b - a:
                take(line_of[a], name, -d, a, b)
        return sorted(out, key=lambda m: m["line"])


def licences(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence notices in every whole text: ``(doc_id, matches array<struct<line, licence, dice>>)``, one row for each input row.

    Texts and templates are compared as ``normalised``: without copyright statements and list marks, spelling variants as one. A segment (the whole text: line -1; a line; a sentence of a line that is none itself) matches the template of the highest Dice coefficient
    over word bigrams if that is at least ``least``. Any other run of words that reaches the limit (full texts in longer ones, notices wrapped over
    lines or inside a line) counts with its first line, unless a match of like or larger size overlaps it; templates of a single word match
    segments alone. Texts are passed over if they hold too few distinct bigrams of every template. The default templates are ``NOTICES`` and the
    bodies and headers in ``licence_texts``.
    Null or empty texts match nothing; ids may be null or repeat; other columns are ignored; an empty table gives no rows. No shuffle.
    """
    if templates is None:
        full = full_texts()
        templates = {k: NOTICES.get(k, ()) + full.get(k, ()) for k in NOTICES.keys() | full.keys()}
    known = templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Templates(known, least)
        kind = pa.list_(pa.struct([("line", pa.int32()), ("licence", pa.string()), ("dice", pa.float64())]))
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                yield pa.record_batch({id_col: part.column(0), "matches": pa.array([mine.scan(t) if t else [] for t in part.column(1).to_pylist()], kind)})

    one = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return one.mapInArrow(run, f"`{id_col}` {one.schema[0].dataType.simpleString()}, matches array<struct<line:int,licence:string,dice:double>>")
