"""Brute-force versions of operators that SQL cannot express."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _ids(docs):
    return [(float("inf") if i is None else i, t) for i, t in docs]


def repeats_in_bytes(docs, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256) for (doc_id, text) rows."""
    rows = [(i, (t or "").encode()) for i, t in _ids(docs)]
    least: dict = {}
    for i, b in rows:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((None if i == float("inf") else i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeats_in_words(docs, length=50):
    rows = [(i, WORD.findall(t or "")) for i, t in _ids(docs)]
    least: dict = {}
    for i, w in rows:
        for p in range(len(w) - length + 1):
            s = tuple(w[p : p + length])
            least[s] = min(least.get(s, i), i)
    out = []
    for i, w in rows:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if least[tuple(w[p : p + length])] < i:
                gone[p : p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((None if i == float("inf") else i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)
