"""Operator 8, licence scans: a trained paragraph classifier with template comparison.

A paragraph is a line with a word.  Lines are classified, and so are the sentences of a run of lines (across
single line breaks) and, of sentences of more than ``WIDE`` words, overlapping windows of so many words, so
that the text around a statement does not thin it out.  A statement counts once, at the line where it
starts.  Words (letters and digits, lower case) and their pairs and triples are sparse features; a multinomial logistic regression over licence families and "none" is
trained by numpy on statements made from the families' templates and on paragraphs of a bounded sample
of the corpus (whole paragraphs; ``SAMPLE`` documents and ``PARAGRAPHS`` of their paragraphs at most, by least
hash).  Probabilities are calibrated by temperature on held-out templates, where also the
probability is set below which a licence paragraph is called ``unknown``.  A prediction is confirmed if
the paragraph, one of its sentences, or a span of a template's length at a window, shares five-word shingles with a template of that family at a
Jaccard similarity of 0.8 or more.

Scoring runs over the bytes of whole Arrow batches; features outside the vocabulary weigh nothing, so a
paragraph costs one hash and one table look-up for each word, pair and triple.

Defined results.  Null, empty or wordless text: no paragraphs.  Null doc_id: kept as null.  Repeated
rows: one result each.  Empty table: no rows; the classifier is then trained without corpus paragraphs.
Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan

#: Documents whose paragraphs stand for "none" in training: those whose ids have the least hashes.
SAMPLE = 400
PARAGRAPHS = 6000
SHINGLE = 5
SIMILAR = 0.8
#: Words of a window in a long sentence, and from one window's start to the next one's.
WIDE, STEP = 12, 4
UNKNOWN = "unknown"
NONE = "none"

#: Names of licence families as statements use them.
NAMES = {
    "apache": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache-2.0", "the Apache Software License"],
    "mit": ["the MIT License", "the MIT licence", "the terms of the MIT License", "the MIT/X11 License"],
    "bsd": ["the BSD License", "the 3-clause BSD License", "the 2-clause BSD License", "the New BSD License"],
    "gpl": ["the GNU General Public License, version 3", "the GNU General Public License, version 2", "the GNU GPL", "the GPL, version 3 or later"],
    "lgpl": ["the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License", "the LGPL, version 2.1"],
    "agpl": ["the GNU Affero General Public License, version 3", "the GNU AGPL"],
    "mpl": ["the Mozilla Public License, version 2.0", "the Mozilla Public License"],
    "isc": ["the ISC License", "the terms of the ISC licence"],
    "epl": ["the Eclipse Public License, version 2.0", "the Eclipse Public License"],
    "cc-by": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License", "a Creative Commons Attribution license"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA 3.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-nd": ["CC BY-ND 4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "cc0": ["CC0 1.0", "the Creative Commons Zero license", "the CC0 public domain dedication"],
}
#: How statements begin, and sentences of the licences themselves.
OPENINGS = ["Licensed under {}.", "This work is licensed under {}.", "Released under {}.", "Distributed under {}.", "This file is available under {}.", "Published under {}.", "This software is distributed under {}.", "This project is made available under {}.", "Code released under {}.", "You may use this file under {}."]
NOTICES = {
    "apache": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.", "You should have received a copy of the GNU General Public License along with this program."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."],
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited.", "Proprietary and confidential."],
}
#: Sentences that use the words of licences and are none.
OTHERS = [
    "The driver renewed his license at the office on Monday.", "Apache helicopters were seen over the public road.", "She studied at MIT and later led the general assembly.",
    "The public library holds a version of the map.", "All seats are reserved for guests.", "The software is slow and the file is large.", "His work is under review by the general public.",
    "The license plate was lost.", "Version 2.0 of the report was released under pressure.", "Rights of way are reserved by the city.", "The foundation published the terms of the debate.",
    "A free copy of the book was granted to any person in the hall.", "Use this file to open the door.", "Creative people share the commons.",
]

_FOLD = np.full(256, 32, dtype=np.uint8)
for _b in range(256):
    if chr(_b).isascii() and chr(_b).isalnum():
        _FOLD[_b] = ord(chr(_b).lower())
    elif _b >= 128:
        _FOLD[_b] = _b
_FOLD[10] = 10
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def tokens(text: str) -> list[bytes]:
    return _WORD.findall(_FOLD[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)].tobytes())


def shingles(words: list[bytes]) -> set[bytes]:
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def templates() -> dict[str, list[str]]:
    out = {f: [o.format(n) for n in names for o in OPENINGS] for f, names in NAMES.items()}
    for f, notices in NOTICES.items():
        out.setdefault(f, []).extend(notices)
    return out


def line_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Of a block: the paragraphs' (document, start byte, end byte, words), and (paragraph, hash) of its
    words, pairs and triples."""
    n = len(data)
    folded = _FOLD[data]
    start, end, doc = scan.words(folded, off)
    head = np.zeros(n + 1, dtype=bool)
    head[off[off < n]] = True
    head[1 : n + 1] |= data == 10
    line_of = np.cumsum(head[:n]) - 1
    heads = np.flatnonzero(head[:n])
    stops = np.append(heads[1:], n)
    line, first, count = np.unique(line_of[start], return_index=True, return_counts=True)
    par = np.repeat(np.arange(len(line)), count)
    owner = np.searchsorted(off, heads[line], "right") - 1
    word = scan.byte_roller(folded).spans(start, end)
    out = [(par, word)]
    for k in (2, 3):
        m = len(word) - k + 1
        at = np.flatnonzero(par[: max(m, 0)] == par[k - 1 :]) if m > 0 else np.zeros(0, np.int64)
        gram = scan.Roller(word, 6).spans(at, at + k) ^ np.uint64(k)
        out.append((par[at], gram))
    return owner, heads[line], stops[line], count, out


def unit_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Of a block: the start byte, end byte and words of its sentences and windows, whether each is a window,
    and (unit, hash) of its words, pairs and triples."""
    folded = _FOLD[data]
    start, end, _ = scan.words(folded, off)
    n = len(start)
    if not n:
        e = np.zeros(0, dtype=np.int64)
        return e, e, e, e.astype(bool), []
    mark = np.zeros(len(data), dtype=np.int64)
    mark[:-1] = np.isin(data[:-1], [33, 46, 63]) & scan.SPACE[data[1:]]
    lines = np.flatnonzero(data == 10)
    worded = np.concatenate([[0], np.cumsum(~scan.SPACE[folded])])
    mark[lines[1:][worded[lines[1:]] == worded[lines[:-1]]]] = 1  # a line without words
    marks = np.concatenate([[0], np.cumsum(mark)])
    doc = np.searchsorted(off, start, "right")
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (marks[start[1:]] > marks[end[:-1]])]))
    stop = np.append(head[1:], n)
    more = np.maximum(-(-(stop - head - WIDE) // STEP) + 1, 0) * (stop - head > WIDE)
    within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    a = np.concatenate([head, np.repeat(head, more) + STEP * within])
    b = np.concatenate([stop, np.minimum(np.repeat(head, more) + STEP * within + WIDE, np.repeat(stop, more))])
    word = scan.byte_roller(folded).spans(start, end)
    roll = scan.Roller(word, 6)
    feats = []
    for k in (1, 2, 3):
        m = np.maximum(b - a - k + 1, 0)
        at = np.arange(m.sum()) + np.repeat(a - (np.cumsum(m) - m), m)
        feats.append((np.repeat(np.arange(len(a)), m), word[at] if k == 1 else roll.spans(at, at + k) ^ np.uint64(k)))
    return start[a], end[b - 1], b - a, np.arange(len(a)) >= len(head), feats


def _one(text: str) -> np.ndarray:
    data = np.frombuffer(text.replace("\n", " ").encode("utf-8"), dtype=np.uint8)
    feats = line_features(data, np.array([0, len(data)]))[4]
    return np.concatenate([h for _, h in feats]) if len(data) else np.zeros(0, np.uint64)


@dataclass
class Model:
    families: list[str]
    vocabulary: np.ndarray  # sorted feature hashes
    weight: np.ndarray  # one row a feature, one column a family; scaled by 1 / temperature
    bias: np.ndarray
    known: float  # least probability of a named family
    quick: np.ndarray  # whether any feature has these 16 low bits

    def probabilities(self, count: np.ndarray, feats: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        z = np.zeros((len(count), len(self.families)))
        for par, h in feats:
            maybe = np.flatnonzero(self.quick[(h & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, h[maybe]), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == h[maybe]
            rows, at = par[maybe[hit]], at[hit]
            if len(rows):
                new = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                z[rows[new]] += np.add.reduceat(self.weight[at], new, axis=0)
        z = z / np.sqrt(count)[:, None] + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(negatives: list[str], seed: int = 5, epochs: int = 300, rate: float = 4.0, decay: float = 1e-4) -> Model:
    """Logistic regression on template statements, plain and disturbed, against ``negatives`` and OTHERS."""
    rng = np.random.default_rng(seed)
    families = [*sorted(templates()), NONE]
    rows: list[tuple[str, int]] = []
    held: list[bool] = []
    for f, statements in sorted(templates().items()):
        for x in statements:
            out = rng.random() < 0.2  # a template is held out with its disturbed copies
            words = x.split()
            for copy in range(3):
                w = list(words)
                if copy and len(w) > 6:  # a word is missing
                    del w[int(rng.integers(len(w)))]
                rows.append((" ".join(w) if copy else x, families.index(f)))
                held.append(out)
    rows += [(x, families.index(NONE)) for x in OTHERS * 4 + negatives]
    held += (rng.random(len(rows) - len(held)) < 0.2).tolist()
    held = np.array(held)
    y = np.array([c for _, c in rows])
    hashes = [_one(s) for s, _ in rows]
    licence = y != families.index(NONE)
    # every feature of a template, and none that only the corpus has: the bias stands for those
    vocabulary = np.unique(np.concatenate([h for h, k in zip(hashes, licence, strict=True) if k] + [_one(s) for s in OTHERS]))
    r = np.repeat(np.arange(len(rows)), [len(h) for h in hashes])
    flat = np.concatenate(hashes)
    at = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
    ok = vocabulary[at] == flat
    size = np.array([max(1, len(tokens(s))) for s, _ in rows])
    x = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
    np.add.at(x, (r[ok], at[ok]), 1)
    x /= np.sqrt(size)[:, None]
    target = np.eye(len(families), dtype=np.float32)[y]
    share = 1 / np.bincount(y, minlength=len(families))[y]
    share[y == families.index(NONE)] *= 4

    def fitted(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b = np.zeros((len(vocabulary), len(families)), dtype=np.float32), np.zeros(len(families), dtype=np.float32)
        s = (share[on] / share[on].sum()).astype(np.float32)[:, None]
        for _ in range(epochs):
            g = (_softmax(x[on] @ w + b) - target[on]) * s
            w -= rate * (x[on].T @ g + decay * w)
            b -= rate * g.sum(axis=0)
        return w, b

    # temperature and threshold come from statements that the first fit has not seen; the model is fitted on all
    w, b = fitted(~held)
    z = x[held] @ w + b
    best = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0), key=lambda t: -np.log(_softmax(z / t)[np.arange(held.sum()), y[held]] + 1e-12).mean())
    p = _softmax(z / best)
    # a named family has to be right in 99 of 100 held-out licence paragraphs
    named = p[:, :-1].argmax(axis=1)
    known = next((t for t in np.linspace(0.3, 0.9, 13) if (m := p[:, :-1].max(axis=1) >= t).any() and (named[m] == y[held][m]).mean() >= 0.99), 0.9)
    w, b = fitted(np.ones(len(rows), dtype=bool))
    quick = np.zeros(1 << 16, dtype=bool)
    quick[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
    return Model(families, vocabulary, (w / best).astype(np.float64), (b / best).astype(np.float64), float(known), quick)


class Templates:
    """Shingles of every template, by family."""

    def __init__(self) -> None:
        self.by = {f: [shingles(tokens(s)) for s in statements] for f, statements in templates().items()}

    def similarity(self, family: str, paragraph: str) -> float:
        """The best Jaccard similarity of the paragraph, or a sentence of it, to a template of the family."""
        best = 0.0
        for part in {paragraph, *re.split(r"(?<=[.;:])\s+", paragraph)}:
            own = shingles(tokens(part))
            if own:
                best = max([best, *(len(own & t) / len(own | t) for t in self.by.get(family, []))])
        return best

    def within(self, family: str, text: str) -> float:
        """The best Jaccard similarity of a span of the text to a template of the family of its length."""
        words = tokens(text)
        best = 0.0
        for t in self.by.get(family, []):
            size = len(t) + SHINGLE - 1
            for i in range(max(1, len(words) - size + 1)):
                own = shingles(words[i : i + size])
                best = max(best, len(own & t) / max(1, len(own | t)))
        return best

    def any(self, paragraph: str) -> float:
        return max(self.similarity(f, paragraph) for f in self.by)


def negatives(docs: DataFrame, sample: int = SAMPLE, paragraphs: int = PARAGRAPHS) -> list[str]:
    """At most ``paragraphs`` whole paragraphs of at most ``sample`` documents, both with the least hashes, without
    those that are like a template.  Ids are chosen first, so only the sample's texts are read and split."""
    ids = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    lines = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).where(F.col("line").rlike("[^\\x20\\x09-\\x0D]"))
    some = lines.orderBy(F.xxhash64("doc_id", "at", "line"), "doc_id", "at", "line").limit(paragraphs).collect()
    t = Templates()
    cue = re.compile(r"licen[cs]|copyright|reserved|permission|redistribut|public domain|creative commons", re.IGNORECASE)
    return [x for x in (r["line"] for r in some) if tokens(x) and not (cue.search(x) and t.any(x) > 0.3)]


_FOUND = "array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean,text:string>>"
_FOUND_ARROW = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_()), ("text", pa.string())]))


class Spans:
    """Statements of one text by place: what overlaps a span is found by binary search among spans of like length."""

    def __init__(self) -> None:
        self.by: dict[int, list[tuple[int, int, int, int, dict]]] = {}
        self.made = 0

    def add(self, a: int, b: int, k: int, entry: dict) -> None:
        self.made += 1
        insort(self.by.setdefault((b - a).bit_length(), []), (a, self.made, b, k, entry), key=lambda x: x[:2])

    def over(self, a: int, b: int) -> list[tuple[int, int, int, dict]]:
        """The spans (start, end, family, entry) that overlap [a, b), in the order in which they were added."""
        out = []
        for bits, spans in self.by.items():
            for x in spans[bisect_left(spans, a - (1 << bits), key=lambda x: x[0]) : bisect_left(spans, b, key=lambda x: x[0])]:
                if x[2] > a:
                    out.append(x)
        return [(x[0], x[2], x[3], x[4]) for x in sorted(out, key=lambda x: x[1])]

    def drop(self, entry: dict, a: int, b: int) -> None:
        spans = self.by[(b - a).bit_length()]
        at = bisect_left(spans, a, key=lambda x: x[0])
        while spans[at][4] is not entry:
            at += 1
        del spans[at]


def _units(m: Model, t: Templates, data: np.ndarray, off: np.ndarray, lines: np.ndarray, found: list[list[dict]], firsts: np.ndarray, taken: dict[int, Spans]) -> None:
    """Adds the statements of sentences and windows to what the lines of a block have shown: ``taken`` has
    the statements so far by document.  Of statements that overlap, the confirmed and likelier counts,
    others only if a template confirms another family; a line's entry is confirmed by its sentence."""
    first, last, count, window, feats = unit_features(data, off)
    if not len(first):
        return
    none = m.families.index(NONE)
    p = m.probabilities(count, feats)
    hits, gone, seen = [], set(), {}
    for i in np.flatnonzero(p[:, none] < 0.5).tolist():
        k, a, b = int(p[i, :none].argmax()), int(first[i]), int(last[i])
        doc = int(np.searchsorted(off, a, "right")) - 1
        text = data[a:b].tobytes().decode("utf-8", "replace")
        if (k, text) not in seen:
            seen[k, text] = t.similarity(m.families[k], text)
        like = seen[k, text]
        if like < SIMILAR and window[i]:  # a statement may begin before the window or end after it
            around = data[max(int(off[doc]), a - 300) : min(int(off[doc + 1]), b + 300)].tobytes().decode("utf-8", "replace")
            like = max(like, t.within(m.families[k], around))
        if like >= SIMILAR or not window[i] or p[i, k] >= m.known:
            hits.append((like < SIMILAR, -float(p[i, k]), b - a, a, b, k, doc, like, text))
    for loose, q, _, a, b, k, doc, like, text in sorted(hits):
        spans = taken.setdefault(doc, Spans())
        if not loose:  # unconfirmed pieces of a confirmed statement are no statements of their own
            for x in spans.over(a, b):
                if a <= x[0] and x[1] <= b and not x[3]["confirmed"]:
                    spans.drop(x[3], x[0], x[1])
                    gone.add(id(x[3]))
        over = spans.over(a, b)
        same = [x for x in over if x[2] == k]
        if same and not loose:
            if not any(x[3]["confirmed"] for x in same):
                same[0][3].update(family=m.families[k], similarity=like, confirmed=True)
        elif not over or not loose:
            at = int(np.searchsorted(lines, a, "right")) - 1
            family = m.families[k] if -q >= m.known or not loose else UNKNOWN
            entry = {"paragraph": at - int(firsts[doc]), "family": family, "probability": -q, "similarity": like, "confirmed": not loose, "text": text}
            spans.add(a, b, k, entry)
            found[doc].append(entry)
    for doc in {x[6] for x in hits}:
        found[doc][:] = sorted((e for e in found[doc] if id(e) not in gone), key=lambda e: e["paragraph"])


def scan_documents(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_paragraphs, found: of every row, its licence paragraphs with family (or unknown),
    calibrated probability, template similarity, whether that confirms it, and the text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model or train(negatives(docs)))

    def run(batches):
        m: Model = sent.value
        t = Templates()
        none = m.families.index(NONE)
        for b in batches:
            number = np.zeros(b.num_rows, dtype=np.int64)
            found: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for row, end, data, off in scan.blocks(b.column("text")):
                owner, start, stop, count, feats = line_features(data, off)
                if not len(owner):
                    continue
                per = np.bincount(owner, minlength=end - row)
                number[row:end] = per
                firsts = np.concatenate([[0], np.cumsum(per)[:-1]])
                p = m.probabilities(count, feats)
                taken: dict[int, Spans] = {}
                for i in np.flatnonzero(p[:, none] < 0.5).tolist():
                    k = int(p[i, :none].argmax())
                    text = data[start[i] : stop[i]].tobytes().decode("utf-8", "replace").strip()
                    like = t.similarity(m.families[k], text)
                    family = m.families[k] if p[i, k] >= m.known or like >= SIMILAR else UNKNOWN
                    found[row + owner[i]].append({"paragraph": i - int(firsts[owner[i]]), "family": family, "probability": float(p[i, k]), "similarity": like, "confirmed": like >= SIMILAR, "text": text})
                    taken.setdefault(int(owner[i]), Spans()).add(int(start[i]), int(stop[i]), k, found[row + owner[i]][-1])
                _units(m, t, data, off, start, found[row:end], firsts, taken)
            yield pa.record_batch([b.column("doc_id"), pa.array(number), pa.array(found, _FOUND_ARROW)], names=["doc_id", "n_paragraphs", "found"])

    return docs.mapInArrow(run, f"doc_id long, n_paragraphs long, found {_FOUND}")


def summary(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_paragraphs, n_licence, n_confirmed, families (sorted, joined by commas), best."""
    return scan_documents(docs, model).select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_licence"),
        F.size(F.filter("found", lambda x: x["confirmed"])).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.col("found.family"))), ",").alias("families"),
        F.array_max(F.col("found.probability")).alias("best"),
    )
