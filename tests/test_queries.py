"""Every query against its SQL, on the smallest data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from verification.check import compare, spark_rows
from verification.oracle import ORACLE
from verification.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, name, SMALL) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    assert spark_rows(spark, name, SMALL)[1]


def test_driver_contract(spark):
    assert entry_point.entry(spark).count() == 50
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("left_out", [("linkloom/llm",), ("linkloom/llm", "corpus_pipeline.py")])
def test_entry_without_corpus_operators(tmp_path, left_out):
    """A copy without the optional subpackage imports and offers all other queries."""
    here = Path(entry_point.__file__).parent
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "linkloom", "verification"):
        if name not in left_out:
            copy = shutil.copytree if (here / name).is_dir() else shutil.copy
            kwargs = {"ignore": lambda folder, _: [n.rpartition("/")[2] for n in left_out if n.startswith("linkloom/")]} if copy is shutil.copytree else {}
            copy(here / name, tmp_path / name, **kwargs)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES), set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.stdout.split() == ["True", "True"], done.stderr
