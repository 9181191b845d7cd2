"""Every named query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from compare import compare, connection
from shoplens.plans import load

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()
# queries without SQL, and the test that holds each against brute force; text queries name theirs beside their own tests
BRUTE_FORCE = {
    "ml_als": ("test_similarity.py", "test_als_solves_its_equations"),
    "mistake_single_pass": ("test_typos.py", "test_single_pass_labels"),
}


@pytest.fixture(scope="module")
def duck():
    return connection(FOLDER)


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    status, text, _ = compare(spark, duck, name, QUERIES[name], ORACLE.get(name), FOLDER)
    if name in ORACLE:
        assert status == "ok", text
    elif name in load().QUERIES:
        file, test = BRUTE_FORCE[name]
        assert f"def {test}(" in (Path(__file__).parent / file).read_text()
