import re
import textwrap

from gridcast.llm import license_scan as s

SCHEMA = "doc_id long, text string, families string"
MARKS = {"gpl": r"GNU General Public License", "cc-by-nc": r"CC BY-NC 4", "mit": r"MIT License", "apache-2.0": r"Apache License"}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scanner = s.fit(s.sample_lines(docs))
    got = {r.doc_id: r for r in s.scan(docs, scanner).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        lines = [f for x in r.text.split("\n") for f, m in MARKS.items() if re.search(m, x)]
        assert got[r.doc_id].n_notices == len(lines) and got[r.doc_id].families == ",".join(sorted(set(lines)))
    assert sum(r.n_notices for r in got.values()) > 5


def test_families_and_odd_texts(spark):
    plain = ["The weather is nice today.", "We went to the public library with a version of the story.", "free software is permitted in general"]
    scanner = s.fit(plain * 50)
    texts = ["", None, "\n"] + [n for notices in s.TEMPLATES.values() for n in notices]
    labels = [""] * 3 + [f for f, notices in s.TEMPLATES.items() for _ in notices]
    texts += [None, "", "\n\n", "x" * 200_000, "a b " * 50_000, *plain, "LICENSED UNDER THE MIT license\n" + "Released under the MIT License.\r\n" * 2]
    labels += [""] * 8 + ["mit"]
    rows = s.scan(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA), scanner).collect()
    assert [r.families for r in sorted(rows, key=lambda r: r.doc_id)] == labels
    assert {r.n_notices for r in rows if r.doc_id == len(texts) - 1} <= {2, 3}
    assert all((r.probability is None) == (r.n_notices == 0) for r in rows)
    assert s.scan(spark.createDataFrame([], SCHEMA), s.fit([])).count() == 0


def test_wrapped_notices(spark):
    scanner = s.fit(["The weather is nice today.", "We went to the public library with a version of the story."] * 50)
    longest = {f: max(notices, key=len) for f, notices in s.TEMPLATES.items()}
    wrap = lambda t, width, mark="": "\n".join(mark + x for x in textwrap.wrap(t, width))
    prose = wrap("we talked about other things for a while and nothing of note came of it " * 40, 70)
    cases = [(wrap(t, width, mark), f, 1) for f, t in longest.items() for width in (30, 50, 72) for mark in ("", "# ", " * ")]
    cases += [(f"{prose}\n{wrap(t, 60)}\n{prose}", f, 1) for f, t in longest.items()]  # no blank line around
    cases += [(f"{prose.replace(chr(10), ' ')} {t} {prose.replace(chr(10), ' ')}", f, 1) for f, t in longest.items()]  # one long line
    two = wrap(longest["gpl"], 40)
    cases += [(f"{two}\n\n{two}", "gpl", 2), (f"{two}\n{prose}\n{two}", "gpl", 2), (f"{two}\n{wrap(longest['bsd'], 40)}", "bsd,gpl", 2)]
    cases += [(f"Released under the MIT License.\n{two}", "gpl,mit", 2), (longest["bsd"].replace("provided", "\n\n").replace("source", "\n\n"), "", 0), (prose, "", 0)]
    got = s.scan(spark.createDataFrame([(i, t, "") for i, (t, *_) in enumerate(cases)], SCHEMA), scanner).collect()
    wrong = [(cases[r.doc_id], r.families, r.n_notices) for r in got if (r.families, r.n_notices) != cases[r.doc_id][1:]]
    assert len(got) == len(cases) and not wrong


def test_the_sample_takes_lines_from_all_places_whatever_the_files(spark):
    rows = [(i, "\n".join(f"line {j} of {i}" for j in range(60)) + "\n" + f"long {i} " * 900, "") for i in range(200)]
    rows += [(None, None, ""), (900, "", ""), (901, "\n\n", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    sample = s.sample_lines(docs.repartition(2))
    assert sample == s.sample_lines(docs.repartition(7)) and len(sample) == s.SAMPLE_LINES
    assert any(x.startswith("line 59 ") for x in sample) and max(map(len, sample)) <= s.STRETCH
    assert any(x.startswith("long") or " long" in x for x in sample) and s.sample_lines(docs.where("doc_id > 800")) == []
