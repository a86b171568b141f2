"""Accounts are counted by the pass that writes, and the source is read once for a window."""

from pyspark.sql import functions as F

from personpub.operators.stats import Account, load_account, load_result
from personpub.plans.increment import run_increment
from personpub.session import settle
from personpub.sources.bindings import load
from personpub.sources.targets import Target

SF = "/root/testdata/sf0.001"


def test_account_equals_a_count_of_its_own(spark, tmp_path):
    person = load(spark, SF, "v_person")
    got = run_increment(person, Target(str(tmp_path / "t"), "id", "updated")).account
    want = load_account(load_result(person))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_window_is_read_once(spark, tmp_path):
    """Every row of the window passes the source's own counter once, failures and account included."""
    person = settle(load(spark, SF, "v_person_json").coalesce(2))
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = person.mapInArrow(passed, person.schema)
    run = run_increment(counted.filter("true"), Target(str(tmp_path / "t"), "id", "updated"))
    run.account.collect(), run.failures.collect(), run.wrong_kinds.collect()
    assert read.value == 2 * person.count()  # the newest change, then the window


def test_empty_rows_give_an_empty_account(spark):
    account = Account()
    settle(account.counted(spark.range(0), F.lit("indexed"), F.lit(None).cast("string")))
    assert account.rows(spark).collect() == []
