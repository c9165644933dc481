"""Every registered query of the reference's operators against its SQL."""

import pytest

from tests.compare import connect, same
from tracewise.plans.oracle import ORACLE_SQL
from tracewise.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_each_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    same(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df())


def test_entry_imports_without_the_training_data_operators(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tracewise", tmp_path / "tracewise", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 40 and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env=os.environ | {"PYTHONPATH": str(tmp_path)})
