"""Licence scan: a trained classifier over sparse word n-grams, with an unknown class and confirmation by templates.

A paragraph is a run of lines with words; lines of comment marks alone end it, as empty ones do, and comment marks are no words. It is read
in windows of ``WINDOW`` words, each beginning half a window after the one before, and every line of no more words is a window too, so neither
wrapped lines nor long paragraphs nor the text around it hide a notice. A multinomial logistic regression over hashed words and word pairs gives each window a probability for every licence family and for none.

In a window that holds a licence with a probability of ``CANDIDATE`` or more, the ``TRIED`` likeliest families, and any other with that
probability, are compared with their templates: a family is confirmed where four fifths of a template's word triples lie around the window. A window that is believed to hold a licence, but where none is confirmed, is ``unknown``; the probability
from which it is believed is calibrated on windows of the corpus held out from training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from catlink.llm.common import Rolling, chain, in_batches, pieces, ragged, runs, sampled

DIMENSIONS = 1 << 15
CONTAINED = 0.8
CANDIDATE = 0.02
TRIED = 4
SCALE = 12.0
WINDOW, STRIDE = 8, 4

# Notices as their licences ask for them to be written.
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved.", "Copyright 2020 the authors. All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_rolling: list[Rolling] = []


@dataclass(frozen=True)
class Settings:
    """Training reads at most ``windows`` windows of about ``sample`` documents, both drawn by hash, and ``variants`` windows of each template."""

    sample: int = 600
    windows: int = 20_000
    variants: int = 60
    rounds: int = 80
    rate: float = 1.0
    false_rate: float = 0.0005


def read_templates(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Templates from text files ``path/FAMILY/…``; each paragraph of a file is a template."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("family"), "value")
    out: dict[str, list[str]] = {}
    for r in rows.collect():  # notices that the user wrote down
        out.setdefault(r["family"], []).extend(r["value"].replace("\r\n", "\n").split("\n\n"))
    return out


class Windows:
    """The words of texts, their paragraphs, and the windows in them with their features."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        if not _rolling:
            _rolling.append(Rolling(6))
        self.start, self.end = runs(_WORD[data], offsets)
        n = len(self.start)
        self.hash = _rolling[0].over(data, _LOWER).of(self.start, self.end) if n else np.zeros(0, np.uint64)
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        new = np.ones(n, bool)
        if n:
            new[1:] = (lines[self.start[1:]] - lines[self.end[:-1]] >= 2) | (self.row[1:] != self.row[:-1])
        self.first = np.flatnonzero(new)
        self.stop = np.append(self.first[1:], n)
        size = self.stop - self.first
        many = np.where(size > WINDOW, -(-(size - WINDOW) // STRIDE) + 1, 1) if n else np.zeros(0, np.int64)
        self.paragraph = np.repeat(np.arange(len(self.first)), many)
        nr = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        begin = self.first[self.paragraph] + np.minimum(nr * STRIDE, np.maximum(size[self.paragraph] - WINDOW, 0))
        length = np.minimum(size[self.paragraph], WINDOW)
        # Short lines of longer paragraphs.
        fresh = np.ones(n, bool)
        if n:
            fresh[1:] = (lines[self.start[1:]] > lines[self.end[:-1]]) | new[1:]
        line = np.flatnonzero(fresh)
        words = np.diff(np.append(line, n))
        of = np.searchsorted(self.first, line, "right") - 1
        short = (words <= WINDOW) & (words > 2) & (words < size[of])
        self.begin, self.length = np.concatenate([begin, line[short]]), np.concatenate([length, words[short]])
        self.paragraph = np.concatenate([self.paragraph, of[short]])

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(feature, window) of all words and word pairs."""
        word, pair = ragged(self.length, self.begin), ragged(self.length - 1, self.begin)
        one, h = np.uint64(1), self.hash
        f = np.concatenate([chain(np.full(len(word), one), h[word]), chain(np.full(len(pair), one + one), h[pair], h[pair + 1])])
        number = np.arange(len(self.begin))
        return (f >> np.uint64(49)).astype(np.int64), np.concatenate([np.repeat(number, self.length), np.repeat(number, self.length - 1)])

    def triples(self, a: int, b: int) -> np.ndarray:
        """Hashes of the word triples of words a to b."""
        return chain(self.hash[a:b - 2], self.hash[a + 1:b - 1], self.hash[a + 2:b]) if b - a > 2 else np.zeros(0, np.uint64)


def plain_words(text: str) -> list[str]:
    """The words of a text as they are compared."""
    return bytes(int(_LOWER[b]) if _WORD[b] else 32 for b in text.encode()).decode("utf-8", "replace").split()


def _of_text(text: str) -> Windows:
    raw = np.frombuffer(text.encode(), np.uint8)
    return Windows(raw, np.array([0, len(raw)]))


class Templates:
    """The word triples of the templates of each family; a template has three words at least."""

    def __init__(self, texts: dict[str, list[str]]):
        self.texts = {f: [t for t in ts if len(_of_text(t).hash) > 2] for f, ts in texts.items()}
        self.families = sorted(f for f, ts in self.texts.items() if ts)
        self.all = np.unique(np.concatenate([np.zeros(0, np.uint64), *[w.triples(0, len(w.hash)) for f in self.families for w in map(_of_text, self.texts[f])]]))
        self.sets = {f: [(np.unique(w.triples(0, len(w.hash))), len(w.hash)) for w in map(_of_text, self.texts[f])] for f in self.families}

    def touched(self, w: Windows) -> np.ndarray:
        """Which windows hold a word triple of any template, a triple that begins or ends in the window being enough."""
        triples = w.triples(0, len(w.hash))
        at = np.minimum(np.searchsorted(self.all, triples), max(len(self.all) - 1, 0))
        hit = np.concatenate([[0], np.cumsum(self.all[at] == triples if len(self.all) else np.zeros(len(triples), bool))])
        return hit[np.clip(w.begin + w.length, 0, len(hit) - 1)] > hit[np.clip(w.begin - 2, 0, len(hit) - 1)]

    def best(self, w: Windows, i: int, family: str) -> tuple[float, int, int]:
        """The largest share of a template's triples around window i, inside its paragraph, and the words from the first to the last of them."""
        low, high = w.first[w.paragraph[i]], w.stop[w.paragraph[i]]
        best = (0.0, int(w.begin[i]), int(w.begin[i] + w.length[i]))
        for triples, n in self.sets[family]:
            a, b = max(low, w.begin[i] - n), min(high, w.begin[i] + w.length[i] + n)
            here = w.triples(a, b)
            hit = np.flatnonzero(np.isin(here, triples))
            share = len(np.unique(here[hit])) / len(triples)
            if share > best[0]:
                best = (share, int(a + hit[0]), int(a + hit[-1] + 3))
        return best


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Model:
    weights: np.ndarray
    bias: np.ndarray
    believed: float

    def probabilities(self, f: np.ndarray, r: np.ndarray, n: int) -> np.ndarray:
        share = 1 / np.maximum(np.bincount(r, minlength=n), 1)
        z = np.stack([np.bincount(r, self.weights[f, c], n) for c in range(self.weights.shape[1])], axis=1)
        return _softmax(z * share[:, None] * SCALE + self.bias)


def _plain_windows(docs: DataFrame, templates: Templates, s: Settings) -> list[np.ndarray]:
    """Features of sampled windows that hold no template by half: at most ``s.windows``, those of the least hash of their features."""
    rows = sampled(docs.filter("text IS NOT NULL").select("doc_id", "text"), "doc_id", s.sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                w = Windows(data, offsets)
                f, r = w.features()
                order = np.argsort(r, kind="stable")
                parts = np.split(f[order].astype(np.int32), np.cumsum(np.bincount(r, minlength=len(w.begin)))[:-1]) if len(w.begin) else []
                free = [i for i, near in enumerate(templates.touched(w).tolist()) if not near or all(templates.best(w, i, c)[0] < 0.5 for c in templates.families)]
                yield pa.RecordBatch.from_arrays([pa.array([parts[i] for i in free], pa.list_(pa.int32()))], ["ids"])

    windows = in_batches(rows, run, "ids array<int>")
    return [np.array(r["ids"]) for r in windows.orderBy(F.xxhash64("ids"), "ids").limit(s.windows).collect()]


def _licence_windows(templates: Templates, plain: list[np.ndarray], s: Settings, draw: np.random.Generator) -> tuple[list[np.ndarray], list[int]]:
    """Windows over templates with a few words left out and features of plain text around them, and the number of their family."""
    out, y = [], []
    for c, family in enumerate(templates.families):
        for template in templates.texts[family]:
            words = template.split()
            for v in range(s.variants):
                kept = [x for x in words if draw.random() > 0.04] if v and len(words) > 5 else words
                a = int(draw.integers(0, max(1, len(kept) - WINDOW + 1)))
                some = kept[a:a + WINDOW]
                f, _ = _of_text(" ".join(some)).features()
                room = WINDOW - len(some)
                if room and v % 3 and plain:
                    other = plain[int(draw.integers(0, len(plain)))]
                    f = np.concatenate([f, draw.permutation(other)[:2 * int(draw.integers(0, room + 1))]])
                out.append(f)
                y.append(c)
    return out, y


def train(docs: DataFrame, settings: Settings = Settings(), templates: Templates | None = None) -> Model:
    """Fit on windows of the templates against windows of a bounded sample of the corpus, each side weighing half.

    A window is believed to hold a licence from the probability that only ``false_rate`` of the held-out windows without one reach, and from one
    half on at least. Windows of hardly any known word are examples without licence too.
    """
    s, draw = settings, np.random.default_rng(7)
    templates = templates or Templates(TEMPLATES)
    plain = _plain_windows(docs, templates, s)
    licensed, y = _licence_windows(templates, plain, s, draw)
    vocabulary = np.unique(np.concatenate([*licensed, np.zeros(0, np.int64)]))
    strange = [draw.integers(0, DIMENSIONS, int(n)) for n in draw.integers(1, 6, 500)]
    mixed = [np.concatenate([draw.choice(vocabulary, 2), draw.integers(0, DIMENSIONS, int(n))]) for n in draw.integers(1, 20, 1000)] if len(vocabulary) else []
    none = len(templates.families)
    rows = [*plain, *licensed, *strange, *mixed]
    y = np.array([none] * len(plain) + y + [none] * (len(strange) + len(mixed)))
    r = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    f = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    v = SCALE / np.maximum(np.bincount(r, minlength=len(rows)), 1)[r]
    unseen = draw.random(len(y)) < 1 / 3
    k = none + 1
    w, b, grad = np.zeros((DIMENSIONS, k)), np.zeros(k), np.full((DIMENSIONS, k), 1e-8)
    of = ~unseen[r]
    ft, rt, vt = f[of], r[of], v[of]
    count = np.bincount(y[~unseen], minlength=k)
    side = np.where(np.arange(k) == none, 0.5, 0.5 / max(none, 1)) / np.maximum(count, 1)
    target, weight = np.eye(k)[y], (side[y] * ~unseen)[:, None]
    for _ in range(s.rounds):
        z = np.stack([np.bincount(rt, vt * w[ft, c], len(y)) for c in range(k)], axis=1) + b
        d = (_softmax(z) - target) * weight
        for c in range(k):
            g = np.bincount(ft, vt * d[rt, c], DIMENSIONS)
            grad[:, c] += g * g
            w[:, c] -= s.rate * g / np.sqrt(grad[:, c])
        b -= d.sum(axis=0)
    model = Model(w.astype(np.float32), b, 0.5)
    no = unseen & (np.arange(len(y)) < len(plain))
    if no.any():
        wrong = np.sort(1 - model.probabilities(f, r, len(y))[no, -1])
        model.believed = max(0.5, float(wrong[min(len(wrong) - 1, int(np.ceil(len(wrong) * (1 - s.false_rate))))]) + 1e-9)
    return model


def _together(spans: list[dict]) -> list[dict]:
    """Spans of one family that overlap or touch are one, with the largest probability and share."""
    out: list[dict] = []
    for x in sorted(spans, key=lambda x: (x["family"], x["start"], x["end"])):
        last = out[-1] if out else None
        if last and last["family"] == x["family"] and x["start"] <= last["end"]:
            last["end"] = max(last["end"], x["end"])
            last["probability"], last["contained"] = max(last["probability"], x["probability"]), max(last["contained"], x["contained"])
        else:
            out.append(dict(x))
    return sorted(out, key=lambda x: (x["start"], x["family"]))


SCHEMA = "n_paragraphs long, found array<struct<start:long,end:long,family:string,probability:double,contained:double>>"


def scan(docs: DataFrame, settings: Settings = Settings(), templates: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, n_paragraphs and found (byte span, family or ``unknown``, probability, share of the best template) of every whole text.

    A paragraph of fewer than three words, which no template has, holds no licence. A span of several families has a row for each that is confirmed; spans of one family that overlap are one, as are those that are unknown.
    Null and empty texts have no paragraphs; repeated rows are scanned each; an empty table gives no rows.
    """
    known = Templates(templates or TEMPLATES)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((train(docs, settings, known), known))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, templates_ = shared.value
        families = templates_.families
        for batch in batches:
            count, found = [], []
            for first, end, data, offsets in pieces(batch.column("text")):
                w = Windows(data, offsets)
                count += np.bincount(w.row[w.first], minlength=end - first).tolist()
                mine: list[list] = [[] for _ in range(end - first)]
                if len(w.begin):
                    f, r = w.features()
                    p, near = model.probabilities(f, r, len(w.begin)), templates_.touched(w)
                    for i in np.flatnonzero((1 - p[:, -1] >= np.where(near, CANDIDATE, model.believed)) & (w.length > 2)).tolist():
                        row = int(w.row[w.begin[i]])

                        def span(family: str, c: int, share: float, a: int, b: int, i: int = i, row: int = row) -> dict:
                            return {"start": int(w.start[a] - offsets[row]), "end": int(w.end[b - 1] - offsets[row]), "family": family, "probability": float(p[i, c]), "contained": share}

                        likely = set(np.argsort(-p[i, :-1], kind="stable")[:TRIED].tolist()) | set(np.flatnonzero(p[i, :-1] >= CANDIDATE).tolist())
                        tried = [(c, *templates_.best(w, i, families[c])) for c in sorted(likely)] if near[i] else []
                        sure = [span(families[c], c, share, a, b) for c, share, a, b in tried if share >= CONTAINED]
                        mine[row] += sure
                        if not sure and 1 - p[i, -1] >= model.believed:
                            c = int(p[i, :-1].argmax())
                            mine[row].append(span("unknown", c, max((x[1] for x in tried), default=0.0), int(w.begin[i]), int(w.begin[i] + w.length[i])))
                found += [_together(_unmet(x)) for x in mine]
            kind_ = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("contained", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(found, kind_)], ["doc_id", "n_paragraphs", "found"])

    return in_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, {SCHEMA}")


def _unmet(spans: list[dict]) -> list[dict]:
    """Without unknown windows that meet a confirmed span: they hold a part of it."""
    sure = [x for x in spans if x["family"] != "unknown"]
    return [x for x in spans if x["family"] != "unknown" or not any(x["start"] < y["end"] and y["start"] < x["end"] for y in sure)]
