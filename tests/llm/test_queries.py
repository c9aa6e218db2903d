"""Registered queries against their SQL, and what holds for those without."""

import pytest

import __spark_entry__ as registry
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from tests.llm.brute import repeats_in_bytes, repeats_in_words
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), ORACLE[name], duck(sf_dir)) == []


@pytest.mark.parametrize(("name", "brute"), [("op7_suffix_dedup", repeats_in_bytes), ("op10_passage_dedup", repeats_in_words)])
def test_query_equals_brute_force(spark, sf_dir, name, brute):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in QUERIES[name](spark, sf_dir).collect()], key=str)
    assert got == brute(docs)


def test_sampled_pieces_give_the_texts_back(spark, sf_dir):
    rows = QUERIES["op3_piece_sampling"](spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and rows.where("not lossless or n_pieces = 0").isEmpty()


def test_all_are_registered():
    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert QUERIES.keys() <= registry.queries().keys() and ORACLE.keys() <= registry.oracle_sql().keys()
