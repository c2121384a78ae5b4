"""Every registered query agrees with its oracle SQL; the entry points work."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import verify  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(entry_points.queries())

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    return verify.oracle(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    got = entry_points.queries()[name](spark, SF_DIR).toArrow()
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
    else:
        assert verify.compare(got, oracle.sql(sql).to_arrow_table()) == ""


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_oracle_names():
    assert set(entry_points.oracle_sql()) <= set(NAMES)
