"""The registered queries on the given tables, and the guard around the subpackage."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as driver  # noqa: E402
from compare import compare, oracle, type_differences  # noqa: E402

from dugout.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_one_query_per_operator():
    assert [int(name.split("_")[0][2:]) for name in queries.QUERIES] == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    db = oracle(FOLDER)
    df = queries.QUERIES[name](spark, FOLDER)
    assert compare(db, queries.SQL[name], df.columns, df.collect()) == ""
    assert type_differences(db, queries.SQL[name], df.dtypes) == {}


def test_the_rest_works_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("dugout.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as driver
assert not any(n.startswith("op") and n[2].isdigit() for n in driver.queries()) and "pipeline" not in driver.queries()
assert set(driver.oracle_sql()) <= set(driver.queries()) and len(driver.queries()) > 70
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
