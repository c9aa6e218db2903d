"""Licence scans by a trained paragraph classifier.

A paragraph is a line with words, or a run of words in consecutive lines with words: notices are often wrapped. Its
features are the words and word pairs, in lower case, that occur in the notices of `TEMPLATES`; a multinomial logistic
regression over these sparse counts tells the licence families and an `unknown` class apart. It is trained here:
families learn from their notices with words dropped, cut and put between words of the corpus; unknown learns from a
bounded sample of the corpus' own lines (`SAMPLE_LINES`) and from mixtures of single notice words. The probability from
which a family counts is set on held-out unknown lines so that at most `FALSE_RATE` of them pass. A prediction stands
only if a notice of that family confirms it: `CONFIRM` of the notice's word pairs must be in the paragraph.

Scanning is one pass without a shuffle: the words of a batch are hashed in arrays, and only lines that hold a word pair
of some notice are scored. Stretches of lines, and lines longer than `WINDOW` words, are also searched in windows, so
placed that every notice lies in one whole: a run of words about as long as a notice that holds enough of its pairs is
scored like a line. A word pair in the text supports one notice only, the one with most pairs first and lines before
runs, so a notice counts once and a part of it makes no other notice. Null and empty texts have no paragraphs. Repeated
lines count each time.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import blocks as B

STRETCH = 2000  # characters of a piece of a line in the sample
SAMPLE_LINES = 4000
FALSE_RATE = 0.001
CONFIRM = 0.6
WINDOW = 96
STRIDE = 32
SLACK = 1.5  # words that a wrapped notice may take, by its pairs
EACH = 150  # training paragraphs a notice
STEPS = 300

#: Notices by family, as licences ask for them to be given.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    "bsd": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Released under the Mozilla Public License."),
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SHIFT = np.uint64(1)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the number of its line. Lines end with a line feed or with their document."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = _IN_WORD[data]
    breaks = data == 10
    line = np.cumsum(np.r_[False, breaks[:-1]])
    first = offsets[(offsets > 0) & (offsets < len(data))]
    more = np.zeros(len(data), np.int64)
    np.add.at(more, first, 1)
    line = line + np.cumsum(more)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | (line[1:] != line[:-1])
    closes[:-1] &= ~inside[1:] | (line[1:] != line[:-1])
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    words = B.run_hashes(B.BYTES[_LOWER[data]], starts, ends)
    return words, line[starts]


def _pairs(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the next."""
    return B.mix((words[:-1] << _SHIFT) ^ B.mix(words[1:]))


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of the word pairs within a line, and the line number of each."""
    words, at = _words(data, offsets)
    same = at[1:] == at[:-1]
    return np.r_[words, _pairs(words)[same]], np.r_[at, at[1:][same]]


def _grams_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.replace("\n", " ").encode(), np.uint8)
    return _grams(data, np.array([0, len(data)]))[0]


@dataclass(frozen=True)
class Scanner:
    vocabulary: np.ndarray  # sorted hashes of words and word pairs
    pairs: np.ndarray  # which of them are word pairs
    weights: np.ndarray  # (vocabulary, classes)
    bias: np.ndarray
    least: float  # probability from which a family counts

    def known(self, grams: np.ndarray) -> np.ndarray:
        """Number of each hash in the vocabulary, -1 for the others."""
        at = np.minimum(np.searchsorted(self.vocabulary, grams), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == grams, at, -1)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        z = counts @ self.weights + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _vocabulary() -> tuple[np.ndarray, np.ndarray, dict]:
    words, pairs, notices = set(), set(), {}
    for family, texts in TEMPLATES.items():
        for text in texts:
            grams = _grams_of(text)
            n = len(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text))
            words |= set(grams[:n].tolist())
            pairs |= set(grams[n:].tolist())
            notices.setdefault(family, []).append(np.unique(grams[n:]))
    every = np.array(sorted(words | pairs), np.uint64)
    return every, np.array([int(h) in pairs for h in every]), notices


VOCABULARY, PAIRS, NOTICES = _vocabulary()
NOTICE_FAMILY = np.array([k for k, f in enumerate(FAMILIES) for _ in NOTICES[f]])
MEMBERS = np.array([np.isin(VOCABULARY, notice) for f in FAMILIES for notice in NOTICES[f]]).astype(np.float32)
SIZES = MEMBERS.sum(1)
FAMILY_PAIRS = [np.flatnonzero(MEMBERS[NOTICE_FAMILY == k].any(0)) for k in range(UNKNOWN)]
LEAST_PAIRS = int(np.ceil(CONFIRM * SIZES.min()))


def _count(rows: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(vocabulary)))
    for i, grams in enumerate(rows):
        at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
        out[i, np.unique(at[vocabulary[at] == grams])] = 1
    return out


def _confirmed(grams: np.ndarray, family: str) -> bool:
    return any(np.isin(notice, grams).mean() >= CONFIRM for notice in NOTICES[family] if len(notice))


def fit(lines: list[str], seed: int = 3) -> Scanner:
    """A scanner from lines of the corpus, which count as unknown unless they hold a notice."""
    draw = np.random.default_rng(seed)
    plain = [x for x in lines if not any(_confirmed(_grams_of(x), f) for f in FAMILIES)]
    filler = [w for x in plain for w in x.split()][:20_000] or ["the", "of"]
    texts, label = [], []
    for k, family in enumerate(FAMILIES):
        for notice in TEMPLATES[family]:
            for i in range(EACH):
                words = notice.split()
                if i % 3 and len(words) > 6:  # a part of it, with a few words lost
                    words = [w for w in words if draw.random() > 0.15]
                around = [[filler[j] for j in draw.integers(0, len(filler), draw.integers(0, 25))] if i % 2 else [] for _ in range(2)]
                texts.append(" ".join([*around[0], *words, *around[1]]))
                label.append(k)
    loose = [w for notices in TEMPLATES.values() for n in notices for w in n.split()]
    for i in range(len(texts)):  # words of notices that make no notice
        words = [loose[j] for j in draw.integers(0, len(loose), draw.integers(1, 6))] + [filler[j] for j in draw.integers(0, len(filler), 12)]
        plain.append(" ".join(draw.permutation(words)))
    texts, label = texts + plain, np.r_[label, np.full(len(plain), UNKNOWN)].astype(int)
    x = _count([_grams_of(t) for t in texts], VOCABULARY)
    held = draw.random(len(x)) < 0.25
    y = np.eye(UNKNOWN + 1)[label]
    w, b = np.zeros((x.shape[1], UNKNOWN + 1)), np.zeros(UNKNOWN + 1)
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    a, t = x[~held], y[~held]
    for _ in range(STEPS):
        z = a @ w + b
        z = np.exp(z - z.max(1, keepdims=True))
        error = z / z.sum(1, keepdims=True) - t
        speed_w = 0.9 * speed_w - 0.5 * (a.T @ error / len(a) + 1e-5 * w)
        speed_b = 0.9 * speed_b - 0.5 * error.mean(0)
        w, b = w + speed_w, b + speed_b
    made = Scanner(VOCABULARY, PAIRS, w, b, 0.0)
    unknown = np.sort(made.probabilities(x[held & (label == UNKNOWN)])[:, :UNKNOWN].max(1)) if (held & (label == UNKNOWN)).any() else np.zeros(1)
    least = max(0.5, float(unknown[int(np.ceil((1 - FALSE_RATE) * len(unknown))) - 1]) + 1e-9)
    return Scanner(VOCABULARY, PAIRS, w, b, least)


def sample_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> list[str]:
    """SAMPLE_LINES pieces of lines, the material for the unknown class: a bounded sample that is the same however the
    corpus is split into files. Every line of every document is a candidate, cut into pieces of STRETCH characters where
    it is longer; those with the least hashes of id, place and piece are taken, first within each task."""
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"[^\\n]{{1,{STRETCH}}}"), F.lit(0))
    every = docs.select(F.col(key).cast("string").alias("id"), F.posexplode(pieces).alias("place", "line"))
    hashed = every.select("line", F.xxhash64("id", "place", "line").alias("h"))
    # First the hashes alone, so that tasks send the driver numbers and not texts; then the texts up to the last of them.
    bound = hashed.select("h").orderBy("h").limit(SAMPLE_LINES).agg(F.max("h").alias("h")).first().h
    if bound is None:
        return []
    return [r.line for r in hashed.where(F.col("h") <= bound).orderBy("h", "line").limit(SAMPLE_LINES).collect()]


def _scan_lines(words: np.ndarray, line: np.ndarray, scanner: Scanner) -> list[tuple[int, int, float]]:
    """(line, family, probability) of each line with a confirmed notice, in order."""
    same = line[1:] == line[:-1]
    grams, line = np.r_[words, _pairs(words)[same]], np.r_[line, line[1:][same]]
    at = scanner.known(grams)
    hit = at >= 0
    if not hit.any():
        return []
    wanted = np.unique(line[hit][scanner.pairs[at[hit]]])
    if not len(wanted):
        return []
    where = np.searchsorted(wanted, line[hit])
    where = np.minimum(where, len(wanted) - 1)
    use = wanted[where] == line[hit]
    out = []
    grams, row, column = grams[hit][use], where[use], at[hit][use]
    order = np.argsort(row, kind="stable")
    grams, row, column = grams[order], row[order], column[order]
    bounds = np.searchsorted(row, np.arange(len(wanted) + 1))
    for i in range(0, len(wanted), 2048):
        j = min(i + 2048, len(wanted))
        counts = np.zeros((j - i, len(scanner.vocabulary)))
        counts[row[bounds[i] : bounds[j]] - i, column[bounds[i] : bounds[j]]] = 1
        p = scanner.probabilities(counts)[:, :UNKNOWN]
        best = p.argmax(1)
        for k in np.flatnonzero(p.max(1) >= scanner.least).tolist():
            if _confirmed(grams[bounds[i + k] : bounds[i + k + 1]], FAMILIES[best[k]]):
                out.append((int(wanted[i + k]), int(best[k]), float(p[k, best[k]])))
    return out


def _windows(line: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word (exclusive) of the windows over each stretch of lines. `opens` has the
    number of the stretch of each line."""
    stretch = opens[line]
    starts = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]])
    ends = np.r_[starts[1:], len(line)]
    wide = (line[starts] != line[ends - 1]) | (ends - starts > WINDOW)  # a short single line is scanned as such
    starts, ends = starts[wide], ends[wide]
    each = np.maximum(1, -(-(ends - starts - WINDOW) // STRIDE) + 1)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    first = np.repeat(starts, each) + nth * STRIDE
    return first, np.minimum(first + WINDOW, np.repeat(ends, each))


def _held(pair: np.ndarray, notice: int) -> tuple[int, int, int]:
    """(distinct pairs of the notice, first, last) in the run of words, no longer than SLACK notices, that holds most."""
    places = np.flatnonzero(MEMBERS[notice][pair] * (pair >= 0)).tolist()
    kinds, times, best, i = pair[places].tolist(), {}, (0, 0, 0), 0
    for j, place in enumerate(places):
        times[kinds[j]] = times.get(kinds[j], 0) + 1
        while place - places[i] >= SLACK * SIZES[notice]:
            times[kinds[i]] -= 1
            if not times[kinds[i]]:
                del times[kinds[i]]
            i += 1
        if len(times) > best[0]:
            best = (len(times), places[i], place)
    return best


def _found(words: np.ndarray, line: np.ndarray, first: np.ndarray, last: np.ndarray, scanner: Scanner) -> list[tuple[int, int, float]]:
    """(first word, family, probability) of each notice, in lines and in windows."""
    word, pair = scanner.known(words), scanner.known(_pairs(words))
    pair[(pair >= 0) & ~scanner.pairs[pair]] = -1
    waiting = []  # (- pairs of the notice, in a window, first word, end, family or notice, probability)
    for k, family, p in _scan_lines(words, line, scanner):
        i, j = (int(x) for x in np.searchsorted(line, [k, k + 1]))
        held = MEMBERS[:, np.unique(pair[i : j - 1][pair[i : j - 1] >= 0])].sum(1)
        waiting.append((-int(held[(NOTICE_FAMILY == family) & (held >= CONFIRM * SIZES)].max()), False, i, j, family, p))
    before = np.r_[0, np.cumsum(pair >= 0)]
    some = before[last - 1] - before[first] >= LEAST_PAIRS
    first, last = first[some], last[some]
    for i in range(0, len(first), 1024):
        a, b = first[i : i + 1024, None], last[i : i + 1024, None]
        place = a + np.arange(WINDOW)
        inside = place < b - 1
        counts = np.zeros((len(a), len(scanner.vocabulary) + 1), np.float32)
        row = np.broadcast_to(np.arange(len(a))[:, None], place.shape)
        counts[row[inside], pair[place[inside]]] = 1  # what is unknown goes to the last column
        for k, notice in np.argwhere(counts[:, :-1] @ MEMBERS.T >= CONFIRM * SIZES).tolist():
            a, b = int(first[i + k]), int(last[i + k])
            waiting.append((-_held(pair[a : b - 1], notice)[0], True, a, b, notice, 0.0))
    heapq.heapify(waiting)
    out = []
    while waiting:
        least, window, a, b, which, p = heapq.heappop(waiting)
        if not window:
            here, family = pair[a : b - 1], which
            if not _confirmed(scanner.vocabulary[here[here >= 0]], FAMILIES[family]):
                continue
        else:
            held, i, j = _held(pair[a : b - 1], which)
            if held < CONFIRM * SIZES[which]:
                continue
            if held < -least:  # another notice has used some of its pairs
                heapq.heappush(waiting, (-held, *(window, a, b, which, p)))
                continue
            here, family = pair[a + i : a + j + 1], int(NOTICE_FAMILY[which])
            counts = np.zeros((1, len(scanner.vocabulary)))
            known = np.r_[word[a + i : a + j + 2], here]
            counts[0, known[known >= 0]] = 1
            chances = scanner.probabilities(counts)[0, :UNKNOWN]
            p = float(chances[family])
            if chances.argmax() != family or p < scanner.least:
                for x, y in ((a, a + i + 1), (a + i + 1, b)):  # there may be one before or after it
                    heapq.heappush(waiting, (-held, window, x, y, which, 0.0))
                continue
            heapq.heappush(waiting, (-held, window, a, b, which, p))  # there may be more of them
            a += i
        out.append((a, family, p))
        here[np.isin(here, FAMILY_PAIRS[family])] = -1
    return out


def _scan(data: np.ndarray, offsets: np.ndarray, scanner: Scanner) -> list[tuple[int, int, float]]:
    """(document, family, probability) of each notice."""
    words, line = _words(data, offsets)
    if not len(words):
        return []
    starts = np.r_[np.flatnonzero(data == 10) + 1, offsets]
    starts = np.r_[0, np.sort(starts[(starts > 0) & (starts < len(data))])]
    document = np.searchsorted(offsets, starts, "right") - 1
    full = np.zeros(len(starts), bool)
    full[line] = True
    first, last = _windows(line, np.cumsum(~full | np.r_[True, document[1:] != document[:-1]]))
    return [(int(document[line[a]]), family, p) for a, family, p in _found(words, line, first, last, scanner)]


def scan(docs: DataFrame, scanner: Scanner, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_notices (lines with a notice, and notices wrapped over lines), families (distinct, in order of the name, joined by commas; empty
    if there is none), probability (of the surest notice, null if there is none)."""

    def made(batches):
        for batch in batches:
            data, offsets = B.flat(pa.Table.from_batches([batch]))
            found: dict[int, list] = {}
            for i, j in B.pieces(offsets):
                for d, family, p in _scan(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], scanner):
                    found.setdefault(i + d, []).append((family, p))
            rows = [found.get(i, ()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([",".join(FAMILIES[k] for k in sorted({f for f, _ in r})) for r in rows], pa.string()),
                    pa.array([max((p for _, p in r), default=None) for r in rows], pa.float64()),
                ],
                names=["doc_id", "n_notices", "families", "probability"],
            )

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(made, f"doc_id {kind}, n_notices long, families string, probability double")
