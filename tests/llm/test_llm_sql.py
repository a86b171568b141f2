"""The operators that SQL can express give the rows of their SQL."""

from types import SimpleNamespace

import pytest

import oracle
from personpub.llm.catalog import QUERIES, SQL


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", list(SQL))
def test_same_rows(spark, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    case = SimpleNamespace(query=QUERIES[name], sql=SQL[name])
    assert oracle.differences(spark, oracle.connect(sf_dir), case, sf_dir) == []
