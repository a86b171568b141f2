import random

from pyspark.sql import functions as F

from personpub.operators.changes import changed_between
from personpub.operators.merge import apply_changes, delete_where, latest, stamp_changes

CHANGE = "id string, version long, kirje string, gone boolean"


def _frame(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def _state(df):
    return {r["id"]: (r["version"], r["kirje"]) for r in df.collect()}


def test_every_kind_of_change(spark):
    target = _frame(spark, [("a", 1, "a1", False), ("b", 1, "b1", False), ("c", 1, "c1", False)])
    changes = _frame(
        spark,
        [
            ("d", 2, "d2", False),  # new key
            ("a", 2, "a2", False),  # changed key
            ("b", 2, "", True),  # tombstone for a present key
            ("x", 2, "", True),  # tombstone for an absent key
            ("e", 2, "e2", False), ("e", 3, "", True), ("e", 4, "e4", False),  # many times
        ],
    )
    target = target.drop("gone")
    once = apply_changes(target, changes, "id", ["version"], "gone")
    want = {"a": (2, "a2"), "c": (1, "c1"), "d": (2, "d2"), "e": (4, "e4")}
    assert _state(once) == want
    assert _state(apply_changes(once, changes, "id", ["version"], "gone")) == want


def test_latest_cuts_before_the_shuffle(spark):
    df = _frame(spark, [("a", i, str(i), False) for i in range(20)])
    plan = latest(df, "id", ["version"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[1]


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], "k string, v string")
    left = delete_where(df, F.col("v") == "")
    assert sorted(r["k"] for r in left.collect()) == ["b", "c"]


def test_window_bounds(spark):
    times = ["10:00:00", "10:00:01", "10:00:02", "10:00:05", "10:00:06"]
    df = spark.createDataFrame(
        [(t, f"2024-01-01 {t}") for t in times], "k string, t string"
    ).select("k", F.col("t").cast("timestamp").alias("updated"))

    def keys(**options):
        last, new = "2024-01-01 10:00:00", "2024-01-01 10:00:05"
        return sorted(r["k"] for r in changed_between(df, last, new, **options).collect())

    assert keys() == ["10:00:01", "10:00:02", "10:00:05"]
    assert keys(overlap=1) == ["10:00:00", "10:00:01", "10:00:02", "10:00:05"]
    assert keys(lag=2) == ["10:00:02", "10:00:05"]
    first = changed_between(df, None, "2024-01-01 10:00:01")
    assert sorted(r["k"] for r in first.collect()) == ["10:00:00", "10:00:01"]


def test_stamp_moves_only_on_change(spark):
    schema = "k string, v string, updated int"
    old = spark.createDataFrame([("a", "x", 1), ("b", None, 1), ("c", None, 1)], schema)
    new = spark.createDataFrame(
        [("a", "x", 0), ("b", None, 0), ("c", "y", 0), ("d", "z", 0)], schema
    )
    stamped = stamp_changes(old, new, "k", F.lit(9)).collect()
    assert {r["k"]: r["updated"] for r in stamped} == {"a": 1, "b": 1, "c": 9, "d": 9}


def test_one_by_one_is_all_at_once(spark):
    rng = random.Random(7)
    rows = [
        (f"k{rng.randrange(8)}", i, f"v{i}", rng.random() < 0.3) for i in range(60)
    ]
    target = _frame(spark, [(f"k{i}", -1, "old", False) for i in range(5)]).drop("gone")
    together = apply_changes(target, _frame(spark, rows), "id", ["version"], "gone")
    state = target
    for part in (rows[:20], rows[20:40], rows[40:]):
        state = apply_changes(state, _frame(spark, part), "id", ["version"], "gone")
    assert _state(state) == _state(together)


def test_latest_sorts_rows_that_were_dealt(spark):
    """What a task sorts does not grow with the rows that its file holds."""
    plan = latest(_frame(spark, [("a", 1, "", False)]), "id", ["version"])._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.split("Exchange")[-1] and len(plan.split("Exchange")) == 3
