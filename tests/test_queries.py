"""Every registered query runs, and equals its SQL where it has one."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import check  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables not present")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_registry():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith(("op", "pipeline"))))
def test_query(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    if name in oracle_sql():
        assert check.compare(got, con.execute(oracle_sql()[name]).df()) is None
