"""The catalogue against its DuckDB twins on the smallest tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from sparkreel import queries as catalogue
from sparkreel.operators import sampling

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got, want = catalogue.queries()[name](spark, SF), db.sql(catalogue.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got.columns, got.collect()) == comparable(want.columns, want.fetchall())


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_all_rounds_are_filled(spark):
    rounds = sampling.generate_rounds(catalogue.samples(spark, SF), catalogue.CONFIG).select("sample_id", "round_id", "frame_indices").collect()
    want = []
    for r in rounds:
        image = "black"
        for position, frame in enumerate(r["frame_indices"]):
            image = f"i{frame}" if frame % 7 else image
            want.append((r["sample_id"], r["round_id"], position, frame, image))
    assert max(w[1] for w in want) > 3
    assert sorted(tuple(r) for r in catalogue.frame_fill_all(spark, SF).collect()) == sorted(want)


@pytest.mark.parametrize("leftover", [False, True])
def test_entry_without_the_llm_folder(tmp_path, leftover):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "sparkreel"), tmp_path / "sparkreel", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    if leftover:
        (tmp_path / "sparkreel/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(catalogue.queries())), "False"]
