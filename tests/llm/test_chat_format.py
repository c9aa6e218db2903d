from pyspark.sql import functions as F

from gridcast.llm.chat_format import preference_pairs

SCHEMA = "conv_id long, turn long, role string, text string, _turn int"


def pairs(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    return {r.pair_id: r for r in preference_pairs(df, F.floor(F.col("conv_id") / 2), F.col("conv_id") % 2 == 0).collect()}


def test_common_turns_are_rendered_once(spark):
    rows = [(0, 0, "system", "Be kind."), (0, 1, "user", "Hi"), (0, 2, "assistant", "Hello é"), (0, 3, "user", "Bye"), (0, 4, "assistant", "Ciao")]
    rows += [(1, 1, "user", "Hi"), (1, 0, "system", "Be kind."), (1, 2, "assistant", "What?")]
    p = pairs(spark, rows)[0]
    assert p.n_common == 2 and p.usable
    assert p.prompt == "<|system|>\nBe kind.<|end|>\n<|user|>\nHi<|end|>\n"
    assert p.rejected == "<|assistant|>\nWhat?<|end|>\n"
    spans = [tuple(map(int, s.split("-"))) for s in p.chosen_spans.split(",")]
    assert [p.chosen[a:b] for a, b in spans] == ["Hello é<|end|>\n", "Ciao<|end|>\n"]
    (a, b), = [tuple(map(int, s.split("-"))) for s in p.rejected_spans.split(",")]
    assert p.rejected[a:b] == "What?<|end|>\n"


def test_odd_conversations(spark):
    rows = [(2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b")]  # equal
    rows += [(4, 0, "user", "alone"), (4, 0, "user", "alone")]  # no other side, repeated rows
    rows += [(6, None, None, None), (6, 1, "assistant", ""), (7, None, None, None), (7, 1, "assistant", "x" * 100_000)]
    rows += [(None, 0, "user", "lost"), (8, 0, "user", "q"), (9, 0, "user", "q"), (9, 1, "assistant", "only one answers")]
    got = pairs(spark, rows)
    assert set(got) == {1, 2, 3, 4}
    assert got[1].n_common == 2 and got[1].chosen == got[1].rejected == "" and not got[1].usable
    assert got[2].n_common == 0 and got[2].rejected is None and got[2].chosen.count("alone") == 2 and not got[2].usable
    assert got[3].n_common == 1 and got[3].prompt == "<||>\n<|end|>\n" and got[3].usable and len(got[3].rejected) > 100_000
    assert got[4].n_common == 1 and got[4].chosen == "" and not got[4].usable
    assert pairs(spark, []) == {}
