import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


HERE = Path(contract.__file__).parent
ALONE = """
import sys; sys.path.insert(0, {copy!r})
{before}
import __spark_entry__ as c
assert c.__file__.startswith({copy!r})
names = set(c.queries())
assert "bundle_full" in names and set(c.oracle_sql()) <= names
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
{after}
"""


def _alone(copy, before="", after=""):
    code = ALONE.format(copy=str(copy), before=before, after=after)
    found = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=300, check=False)
    assert found.returncode == 0, found.stderr[-2000:]


@pytest.fixture
def library_copy(tmp_path):
    """The library without its optional part."""
    copy = tmp_path / "copy"
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", ".pytest_cache")
    shutil.copytree(HERE, copy, ignore=skip)
    return copy


def test_library_without_its_optional_part(library_copy):
    """The core imports, and its flagship query runs, whether the pipeline is there or not."""
    run = """
from sluice.session import build_session
spark = build_session("local[2]", 2, "copy")
assert c.entry(spark).count() > 0
spark.stop()
"""
    _alone(library_copy, after=run)
    (library_copy / "corpus_pipeline.py").unlink(missing_ok=True)
    _alone(library_copy)


@pytest.mark.skipif(not (HERE / "sluice" / "llm").exists(), reason="the optional part is not there")
def test_missing_libraries_take_only_the_optional_part_away(library_copy):
    skip = shutil.ignore_patterns("__pycache__")
    shutil.copytree(HERE / "sluice" / "llm", library_copy / "sluice" / "llm", ignore=skip)
    _alone(library_copy, before="sys.modules['zstandard'] = sys.modules['tokenizers'] = sys.modules['regex'] = None")


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert got
    if name not in SQL:
        return
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in places)) for r in found.fetchall())
