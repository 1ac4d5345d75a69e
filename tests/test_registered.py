import pytest

from __spark_entry__ import entry
from checks.compare import connect, differences
from checks.queries import QUERIES
from checks.twins import TWINS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twins():
    return connect(SF)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == TWINS.keys()


def test_entry(spark):
    assert entry(spark).columns[-1] == "ROW_HASH"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, twins, name):
    assert differences(QUERIES[name](spark, SF), twins, TWINS[name]) == []
