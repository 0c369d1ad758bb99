"""Driver contract: entry() and every registered query against its oracle."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from habita.plans import registry
from tests.conftest import SF_SMALL

sys_path = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "n_listings" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_the_core_stands_without_the_training_data_operators(tmp_path):
    """With the two folders gone (and with or without the pipeline file) the core queries are all there."""
    copy = tmp_path / "repo"
    shutil.copytree(sys_path, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    core = len(registry.queries()), len(registry.oracle_sql())
    for _ in range(2):
        said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True,
                              env=os.environ | {"PYTHONPATH": str(copy)}).stdout
        assert tuple(map(int, said.split())) == core
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


def _norm(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        return round(x, 6) if isinstance(x, float) else x
    return sorted((tuple(v(r[i]) for i in order) for r in records), key=repr)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "float": "FLOAT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(st, st) == duck_types[f.name], (f.name, st, duck_types[f.name])
    assert _norm(sdf.columns, [tuple(r) for r in sdf.collect()]) == _norm(rel.columns, rel.fetchall())
