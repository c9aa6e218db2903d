import random
import re
from collections import Counter
from itertools import permutations

import pytest

from gridcast.llm import filter_audit, text_tries
from gridcast.llm.text_tries import NULL_ID, Routes, Trie

SCHEMA = "doc_id long, text string, lang string, mask string, part int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    order = lambda i: NULL_ID if i is None else i
    least = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", NULL_ID), order(i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)}
        fails |= {"D": bool(re.search(r"[#$%&*|]", t)), "E": order(i) > least[t]}
        rows.append((lang or "", {f for f in fails if fails[f]}, i in good, i in bad))
    out, shares = Counter(), Counter()
    parts = {r[0] for r in rows}
    for o in map("".join, permutations("ABCDE")):
        for k, f in enumerate(o):
            for part in parts:
                own = [r for r in rows if r[0] == part]
                gone = [r for r in own if f in r[1] and not r[1] & set(o[:k])]
                out[part, o, k + 1] = (
                    sum(not r[1] & set(o[: k + 1]) for r in own),
                    len(gone),
                    sum(f in r[1] and bool(r[1] & set(o[:k])) for r in own),
                    sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone),
                    sum(r[3] for r in gone),
                )
                shares[part, f] += len(gone)
    return sorted((p, o, s, *v, shares[p, o[s - 1]]) for (p, o, s), v in out.items())


def made(seed=4):
    r = random.Random(seed)
    body = lambda: " ".join(r.choice(["ab", "Cd", "EF", "gh", "#i", "é"]) + str(r.randint(0, 400)) for _ in range(r.choice([3, 99, 100, 130])))
    shared = [body() for _ in range(6)]
    docs = [(i, r.choice(shared) if r.random() < 0.4 else body(), r.choice(["en", "de", None, ""])) for i in range(120)]
    docs += [(300 + i, shared[0], "en") for i in range(150)]  # a large group of copies
    docs += [(i, shared[1][:k], "fr") for i, k in enumerate(range(500, 560))]  # prefixes of each other
    docs += [(None, shared[2], "en"), (None, shared[2], "en"), (None, "lone", None), (7, None, "en"), (8, "", "en"), (8, "", "en"), (None, None, None)]
    docs += [(900, "word " * 300, "en"), (901, "A" * 5000, "en"), (902, " " * 200, "en"), (903, "a\x1cb\x85c " * 60, "en")]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 400, 2)] + [(2, 1, None), (2, None, 1), (None, 1, 1), (8, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("range_bytes", [1 << 30, 2000])
def test_equals_brute_force(spark, monkeypatch, range_bytes):
    docs, labels = made()
    if range_bytes == 2000:
        monkeypatch.setattr(text_tries, "FLUSH_BYTES", 3000)
        monkeypatch.setattr(text_tries, "PREFIX", 4)  # prefixes don't tell the texts apart: parts by hash
        monkeypatch.setattr(filter_audit, "PIECE", 50)
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, t, lang in docs], SCHEMA).repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(df, known, range_bytes=range_bytes)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, labels)


def test_empty_table(spark):
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], SCHEMA), known).count() == 0


def test_trie_keeps_every_text_apart():
    r = random.Random(2)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(500)] + [b"a" * 100_000, b"a" * 99_999, b"a" * 50_000 + b"b"]
    trie, least, n = Trie(), {}, Counter(texts)
    for i, t in enumerate(texts):
        trie.insert(t, 1000 - i, t)
        least[t] = 1000 - i
    found = {node.rows[0]: node for node in trie.terminals()}
    assert found.keys() == n.keys() and all(set(x.rows) == {t} and len(x.rows) == n[t] and x.least == least[t] for t, x in found.items())


def test_routes_send_equal_texts_one_way_and_spread_the_rest():
    texts = [f"common beginning {i:05d} and more".encode() for i in range(4000)]
    routes = Routes(texts[::4], 16)
    n = Counter(map(routes.of, texts))
    assert len(n) == 16 and max(n.values()) < 400 and all(0 <= x < routes.size for x in n)
    blunt = Routes([t[:4] for t in texts], 16)  # one prefix: parts by hash
    n = Counter(map(blunt.of, texts))
    assert len(n) == 16 and max(n.values()) < 400
    assert Routes([], 5).of(b"") < 5 and Routes([b""], 1).of(b"x") == 0
