"""Every registered query gives the rows of its SQL."""

import pytest

import oracle
from personpub.plans.catalog import CASES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(CASES))
def test_same_rows(spark, con, name):
    assert oracle.differences(spark, con, CASES[name], SF) == []
