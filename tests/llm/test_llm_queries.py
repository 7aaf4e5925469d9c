"""Registered queries against their SQL, and the optional registration."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry_module
from urbanlens.llm.queries import ORACLE_SQL, QUERIES
from urbanlens.plans.verify import _rows, oracle_frame

SF = "/root/testdata/sf0.001"


def test_names_are_registered():
    names = set(entry_module.queries())
    assert names >= set(QUERIES) | {"pipeline"}
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(ready, name):
    got = QUERIES[name](ready, SF).toPandas()
    want = oracle_frame(ORACLE_SQL[name], SF)
    assert _rows(got) == _rows(want)


def test_entry_works_without_the_package():
    code = ("import sys; sys.modules['urbanlens.llm'] = None\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not [n for n in e.queries() if n.startswith('op')] and 'pipeline' not in e.queries()\n"
            "assert set(e.oracle_sql()) <= set(e.queries())")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry_module._HERE)


def test_nothing_else_imports_the_package():
    found = subprocess.run(["grep", "-rlE", "urbanlens.llm|corpus_pipeline", "--include=*.py", "urbanlens", "bench.py"],
                           cwd=entry_module._HERE, capture_output=True, text=True).stdout.split()
    assert all(f.startswith("urbanlens/llm/") for f in found)
