"""The same queries when one key holds a third of the rows.

The tables are copies of the smallest test tables in which a third of the
orders, events and lines belong to one key.
"""

import duckdb
import pytest

import oracle
from personpub.operators import joins
from personpub.plans.catalog import CASES

SF = "/root/testdata/sf0.001"
CHANGED = {
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end"
    " as o_custkey) from t",
    "events": "select * replace (case when event_id % 3 = 0 then 5 else user_id end as user_id)"
    " from t",
    "lineitem": "select * replace (case when l_partkey % 3 = 0 then 2 else l_orderkey end"
    " as l_orderkey) from t",
}
NAMES = [
    "scan_record", "scan_person_json", "statistics", "records_json", "attach_records",
    "attach_relations", "attach_plate", "full_rebuild", "orphans", "latest", "apply_changes",
    "properties_est", "entity_find", "entity_search", "running_totals", "publish_update",
    "publish_stream", "full_rebuild_lists", "orphans_in_cells", "properties_in_cells", "json_elements", "nested", "in_register", "scan_stone", "resolve_person",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in oracle.TABLES:
        sql = CHANGED.get(name, "select * from t").replace(
            "from t", f"from '{SF}/{name}.parquet'"
        )
        con.execute(f"copy ({sql}) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def con(skewed):
    return oracle.connect(skewed)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, con, skewed, name):
    assert oracle.differences(spark, con, CASES[name], skewed) == []


def test_any_heavy_key_of_a_lookup_is_split(spark):
    """2,000 keys of many rows each and one of a third of all, behind an aggregate by the same key."""
    rows = spark.range(600_000).selectExpr("if(id % 3 = 0, -1, id % 2000) as k", "id").groupBy("k", "id").count()
    table = spark.range(-1, 2000).selectExpr("id as k", "'x' as v")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = joins.lookup(rows, table, "k")
        assert joined.filter("v = 'x'").count() == 600_000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_rows_without_key_are_kept(spark):
    rows = spark.range(300).selectExpr("id", "if(id % 2 = 0, null, id) as k")
    table = spark.range(0, 300, 3).selectExpr("id as k", "'x' as v")
    joined = joins.lookup(rows, table, "k")
    assert joined.count() == 300
    assert joined.filter("v is not null").count() == 50
