import hashlib
import re

import pytest

from gridcast.llm import fill_middle as fim

SCHEMA = "doc_id long, text string, form string, n string"


def plain(doc_id, text, seed=7, rate=100, spm=50, marks=fim.SENTINELS):
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in marks) or h[2] % 100 >= rate:
        form, out = "plain", t
    elif h[3] % 100 < spm:
        form, out = "spm", marks[1] + s + marks[0] + p + marks[2] + m
    else:
        form, out = "psm", marks[0] + p + marks[1] + s + marks[2] + m
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, n, form, *((len(p), len(m)) if form != "plain" else (None, None)), sha(out), sha(t), out)


def odd():
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "é\nß\n\nend", "<P", "P>\n<", "<S>", "x\n<M>y\n", "<<P\n>S>", "<P\n<S\n<M\n>\n>"]
    texts += ["\n".join("zeile" * (i % 7) for i in range(k)) for k in range(0, 60, 3)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    return rows + [(None, "a\nb\nc"), (None, None), (5, "other\ntext"), (5, "other\ntext"), (-3, "one\n" * 9)]


@pytest.mark.parametrize(("rate", "spm", "marks"), [(100, 50, fim.SENTINELS), (60, 100, ("<|pre|>", "<|suf|>", "<|mid|>")), (0, 0, fim.SENTINELS)])
def test_equals_a_plain_version_and_comes_back(spark, rate, spm, marks):
    rows = odd()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    out = fim.fill_in_middle(df, rate=rate, spm_rate=spm, sentinels=marks, keep_text=True)
    assert sorted(map(tuple, out.collect()), key=str) == sorted((plain(i, t, 7, rate, spm, marks) for i, t in rows), key=str)
    back = fim.restore_texts(out, sentinels=marks).select("doc_id", "restored").collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_long_texts_move_in_windows(spark, monkeypatch):
    text = "".join(f"line {i} é\n" for i in range(400_000))  # over four windows
    rows = [(i, text[i:]) for i in range(4)] + [(9, "x" * 3_000_000), (10, "short\none")]
    got = fim.fill_in_middle(spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain(i, t)[:-1] for i, t in rows)


def test_empty_table_and_bad_sentinels(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert fim.fill_in_middle(df).count() == 0
    for marks in (("<P>", "<P>", "<M>"), ("<P>", "S", "<M>"), ("<P>", "<a<b>", "<M>"), ("<P>", "", "<M>")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(df, sentinels=marks)
