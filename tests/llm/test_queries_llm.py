"""The registered queries beside their SQL, and that the rest of the library does without this folder."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as e
from compare import compare, connect
from conftest import DATA
from ledgerline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    rows, error = compare(spark, DATA, name, QUERIES[name], ORACLE[name], connect(DATA))
    assert error is None, error
    assert rows > 0


def test_names():
    assert [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in QUERIES) != 1] == []
    assert {*QUERIES, "pipeline"} <= set(e.queries()) and set(ORACLE) <= set(e.oracle_sql())


def test_nothing_else_imports_this_folder():
    root = os.path.dirname(os.path.abspath(e.__file__))
    for at, _, names in os.walk(os.path.join(root, "ledgerline")):
        if not at.endswith("llm"):
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(at, name)) as f:
                        assert "ledgerline.llm" not in f.read(), name
    code = "import sys; sys.path.insert(0, sys.argv[1]); import ledgerline.catalog as c; print(len(c.QUERIES), any('llm' in m for m in sys.modules))"
    out = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and out[1] == "False"
