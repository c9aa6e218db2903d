"""Rules for the library's own source."""

import ast
import re
from pathlib import Path

PACKAGE = Path(__file__).resolve().parents[1] / "gridcast"
SOURCES = {p: p.read_text() for p in PACKAGE.rglob("*.py")}


def test_no_wall_clock_and_no_unsafe_cuts():
    banned = r"current_date|current_timestamp|\bnow\(|localCheckpoint|\.toPandas\(|\.rdd\b|crossJoin|monotonically_increasing_id"
    assert {p.name: re.findall(banned, s) for p, s in SOURCES.items() if re.search(banned, s)} == {}


def test_collect_only_where_bounded():
    allowed = {"flows.py"}  # at most one row per product and cycle
    assert {p.name for p, s in SOURCES.items() if ".collect()" in s and "llm" not in p.parts} <= allowed


def test_no_python_udf():
    """Only windows that the first event opens are folded in Python: their order and timer have no built-in operator."""
    assert not [p for p, s in SOURCES.items() if re.search(r"pandas_udf|F\.udf|applyInPandas\b", s) and "llm" not in p.parts]
    folds = {(p.name, x) for p, s in SOURCES.items() for x in re.findall(r"\.(mapInPandas|applyInPandasWithState)\(", s)}
    assert folds == {("events.py", "mapInPandas"), ("jobs.py", "applyInPandasWithState")}


def test_every_module_says_what_it_is_for():
    assert [p.name for p, s in SOURCES.items() if not ast.get_docstring(ast.parse(s))] == []


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    import pytest

    from gridcast import session

    def on(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(on("spark://host:7077"))
    with pytest.raises(ValueError):
        session.shared_dir(on("local-cluster[3,2,1024]"))
    assert session.shared_dir(on("yarn", "hdfs://nn/shared/")) == "hdfs://nn/shared"
    assert session.shared_dir(on("local[4]"))
