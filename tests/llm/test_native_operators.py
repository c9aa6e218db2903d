"""Quality rules and mixing: SQL as the second opinion on odd rows, and plans without Python."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gridcast.llm import mixing, quality_rules
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from tests.oracle import TABLES, compare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    prose = "the sun rose over {} hills and every bird in the valley began to sing its own small song of the morning"
    rows = [(i, " ".join(prose.format(i * j) for j in range(1 + i % 5)), "en", f"s{i % 4}", 1) for i in range(40)]
    rows += [(50, None, None, None, None), (51, "", None, None, None), (52, " \n\t\x0b\x0c\r\n ", "x", "s1", 0), (None, prose * 3, None, "s9", 1), (7, rows[7][1], "en", "s3", 1)]
    rows += [(60, "Home\nMENU\nread more\n" + " ".join(f"word{i}" for i in range(90)), "en", "é", 1), (61, ("A | B | C | D\n" * 30) + prose, "en", "😀", 1)]
    rows += [(62, "same words again " * 400, "en", "s2", 1), (63, "!!! " * 80, "en", "s2", 1), (64, "ALL CAPS LINE HERE NOW ÉÈ\n" * 20, "fr", "s2", 1)]
    rows += [(65, f"Click here for our Cookie Policy {prose}\n" * 9, "en", "s2", 1), (66, "$# %% | " * 60, "en", "s2", 1), (67, "word " * 20_000, "en", "huge", 1)]
    return rows + [(70 + i, prose.format(i) * 40, "en", "huge", 1) for i in range(30)]


@pytest.mark.parametrize("name", ["op4_quality_rules", "op8_mixing", "op9_ngram_join"])
def test_odd_rows_equal_sql(spark, tmp_path, name):
    spark.createDataFrame(odd_rows(), SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(QUERIES[name](spark, str(tmp_path)), ORACLE[name], con) == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert quality_rules.clean_documents(none).count() == 0 and mixing.mix(none).count() == 0 and mixing.mix_rows(none).count() == 0


def test_lines_are_cleaned_before_documents_are_judged(spark):
    rows = {r.doc_id: r for r in quality_rules.clean_documents(spark.createDataFrame(odd_rows(), SCHEMA)).collect()}
    assert rows[60].kept and rows[60].n_lines_removed == 3 and not re.search("MENU|more", rows[60].clean_text)
    assert not rows[61].kept and not rows[65].kept and rows[67].base_failed and not rows[50].kept


def test_targets_stop_at_three_times_the_size(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 1), (None, 500), ("d", 0)]
    t = {r.source: r for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    # shares of the rest go by weight: b has 2 and the null source, last of five, 2
    assert t["a"].target == 30 and t["c"].target == 3 and t["d"].target == 0
    assert abs(sum(r.target for r in t.values()) - 1511) < 1e-6 and t["b"].target == pytest.approx(1478 / 4 * 2) and t[None].target == pytest.approx(1478 / 4 * 2)


def test_a_smaller_target_takes_a_subset(spark):
    """Thresholds are nested: where the other sources grow smaller, a source keeps a part of what it had."""
    rows = [(i, "w " * (1 + i % 9), "en", "big" if i % 3 else "other", 1) for i in range(900)]
    taken = lambda data: {r.doc_id for r in mixing.mix(spark.createDataFrame(data, SCHEMA)).collect() if r.source == "other" and r.taken}
    few = [r for r in rows if r[3] == "other" or r[0] % 9 == 1]
    a, b = taken(few), taken(rows)
    assert a <= b or b <= a


def test_rows_of_one_id_come_near_the_target(spark, tmp_path):
    """A source of rows without an id, some alike in every way, and one whose rows are all one row."""
    rows = [(None, "ten words " * 5, "en", "alike", 1)] * 401 + [(None, "w " * (1 + i % 9), "en", "null ids", 1) for i in range(300)]
    rows += [(7, f"one id {i}", "en", "one id", 1) for i in range(500)] + [(i, "w " * 40, "fr", None, 1) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(QUERIES["op8_mixing"](spark, str(tmp_path)), ORACLE["op8_mixing"], con) == []
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("size")).collect()
    assert all(abs(r.taken - r.target) <= r.size for r in got)
    copies = mixing.mix_rows(docs).groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("taken")).collect()
    assert {r.source: r.taken for r in copies} == {r.source: r.taken for r in got}


@pytest.mark.parametrize("name", ["op4_quality_rules", "op6_chat_format", "op8_mixing"])
def test_native_plans_have_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_every_query_with_sql_is_registered():
    assert ORACLE.keys() <= QUERIES.keys() and len(TABLES) == 14
