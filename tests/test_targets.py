import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from personpub.plans.increment import run_increment
from personpub.sources import targets
from personpub.sources.outputs import load_mark, save_mark, snapshot
from personpub.sources.targets import Busy, Target, current, drop_target, forget, publish, read_keys, read_target, recover
from personpub.streaming.publish import stream_publish

ROW = "id string, version long, kirje string, _deleted boolean"


@pytest.fixture()
def target(tmp_path):
    return Target(str(tmp_path / "doc"), key="id", version="version", buckets=4)


def _rows(spark, rows):
    return spark.createDataFrame(rows, ROW)


def _state(spark, target, **options):
    return {r["id"]: r["kirje"] for r in read_target(spark, target, **options).collect()}


def test_recreate_then_update(spark, target):
    publish(_rows(spark, [("a", 1, "a1", False), ("b", 1, "b1", False)]), target, "recreate")
    publish(_rows(spark, [("b", 2, "", True), ("c", 2, "c2", False)]), target, "update")
    assert _state(spark, target) == {"a": "a1", "c": "c2"}
    publish(_rows(spark, [("z", 3, "z3", False)]), target, "recreate")
    assert _state(spark, target) == {"z": "z3"}


def test_late_rows_do_not_win(spark, target):
    publish(_rows(spark, [("a", 5, "a5", False), ("b", 5, "", True)]), target, "update")
    publish(_rows(spark, [("a", 4, "a4", False), ("b", 4, "b4", False)]), target, "update")
    assert _state(spark, target) == {"a": "a5"}
    publish(_rows(spark, [("a", 5, "again", False)]), target, "update")
    assert _state(spark, target) == {"a": "again"}  # same second as the mark


def test_replayed_batch_is_skipped(spark, target):
    rows = _rows(spark, [("a", 1, "a1", False)])
    assert not publish(rows, target, "update", batch="x:1").skipped
    publish(_rows(spark, [("a", 2, "a2", False)]), target, "update", batch="x:2")
    assert publish(rows, target, "update", batch="x:1").skipped
    assert _state(spark, target) == {"a": "a2"}
    publish(rows, target, "update")  # the same rows under no name change nothing either
    assert _state(spark, target) == {"a": "a2"}


def test_updates_in_any_order_keep_the_state(spark, target):
    publish(_rows(spark, [(f"k{i}", 0, "old", False) for i in range(20)]), target, "recreate")
    rng, want = random.Random(3), {f"k{i}": "old" for i in range(20)}
    for version in range(1, 5):
        rows = [(f"k{rng.randrange(25)}", version, f"v{version}", rng.random() < 0.3)
                for _ in range(6)]
        rows = list({r[0]: r for r in rows}.values())
        publish(_rows(spark, rows), target, "update")
        for key, _, text, gone in rows:
            want.pop(key, None)
            if not gone:
                want[key] = text
    assert _state(spark, target) == want
    hidden = set(_state(spark, target, with_tombstones=True)) - set(want)
    assert hidden
    forget(spark, target, F.lit(99))
    assert _state(spark, target, with_tombstones=True) == want
    publish(_rows(spark, [("new", 9, "n", False)]), target, "update")
    assert _state(spark, target) == {**want, "new": "n"}


def _files(target):
    return {str(f): f.stat().st_mtime_ns for f in Path(target.rows).rglob("part-*.parquet")}


def test_untouched_partitions_keep_their_files(spark, target):
    publish(_rows(spark, [(f"k{i}", 0, "old", False) for i in range(40)]), target, "recreate")
    before = _files(target)
    done = publish(_rows(spark, [("k7", 1, "new", False)]), target, "update")
    after = _files(target)
    assert len(done.buckets) == 1
    touched = {f for f in before if f"_bucket={done.buckets[0]}/" in f}
    assert touched and not touched & set(after)
    assert {f: s for f, s in before.items() if f not in touched} == {
        f: s for f, s in after.items() if f"_bucket={done.buckets[0]}/" not in f
    }
    assert _state(spark, target) == {**{f"k{i}": "old" for i in range(40)}, "k7": "new"}
    assert publish(_rows(spark, []), target, "update", mark="m").buckets == []
    assert _files(target) == after and current(spark, target).mark == "m"
    assert not [f for f in Path(target.root).rglob("*") if "next" in f.parts and f.is_file()]


def test_keys_are_read_from_their_partitions(spark, target):
    publish(_rows(spark, [(f"k{i}", 0, f"v{i}", i == 3) for i in range(40)]), target, "recreate")
    keys = spark.createDataFrame([("k1",), ("k3",), ("k1",), ("none",), (None,)], "id string")
    assert [r["kirje"] for r in read_keys(spark, target, keys).collect()] == ["v1"]
    assert {r["kirje"] for r in read_keys(spark, target, keys, True).collect()} == {"v1", "v3"}


def test_a_second_writer_is_refused(spark, target, monkeypatch):
    publish(_rows(spark, [("a", 1, "a1", False)]), target, "update")
    real, tried = targets._write, []

    def write(*args):
        for work in (
            lambda: publish(_rows(spark, [("a", 9, "b", False)]), target, "update"),
            lambda: publish(_rows(spark, [("a", 9, "b", False)]), target, "recreate"),
            lambda: drop_target(spark, target), lambda: forget(spark, target, F.lit(1)),
        ):
            with pytest.raises(Busy):
                work()
            tried.append(1)
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(targets, "_write", write)
        publish(_rows(spark, [("a", 2, "a2", False)]), target, "update")
    assert tried and _state(spark, target) == {"a": "a2"}


@pytest.mark.parametrize("at", ["next", "rows", "about"])
def test_a_run_that_died_is_finished_or_dropped(spark, target, monkeypatch, at):
    """At each point the old or the new state is there after recover(), with its mark and batch."""
    publish(_rows(spark, [(f"k{i}", 1, "old", False) for i in range(9)]), target, "update", batch="b:1", mark="1")
    rows = _rows(spark, [("k1", 2, "new", False), ("k2", 2, "", True)])
    with monkeypatch.context() as patch:
        if at == "about":
            real = targets.replace_text
            patch.setattr(targets, "replace_text", lambda s, p, t: _die() if p.endswith("json") else real(s, p, t))
        else:
            real = targets._write
            patch.setattr(targets, "_write", lambda *a: _die() if (a[3] == "dynamic") == (at == "rows") else real(*a))
        patch.setattr(targets, "remove", lambda *_: None)  # a dead process cleans nothing up
        with pytest.raises(OSError):
            publish(rows, target, "update", batch="b:2", mark="2")
    with pytest.raises(Busy):
        publish(rows, target, "update", batch="b:2", mark="2")
    assert recover(spark, target) == (at != "next")
    old = {f"k{i}": "old" for i in range(9)}
    new = {k: "new" if k == "k1" else v for k, v in old.items() if k != "k2"}
    assert _state(spark, target) == (old if at == "next" else new)
    assert current(spark, target).mark == ("1" if at == "next" else "2")
    assert publish(rows, target, "update", batch="b:2", mark="2").skipped == (at != "next")
    assert _state(spark, target) == new
    assert not recover(spark, target)


def _die():
    raise OSError("died")


def test_buckets_are_those_of_the_table(spark, target):
    publish(_rows(spark, [(f"k{i}", 5, f"v{i}", False) for i in range(50)]), target, "recreate")
    same = Target(target.root, "id", "version")
    assert [len(read_target(spark, same, key=f"k{i}").collect()) for i in range(10)] == [1] * 10
    publish(_rows(spark, [(f"k{i}", 4, "late", False) for i in range(50)]), same, "update")
    assert _state(spark, same) == {f"k{i}": f"v{i}" for i in range(50)}
    for other in (
        Target(target.root, "id", "version", buckets=5),
        Target(target.root, "kirje", "version"),
        Target(target.root, "id", "kirje"),
    ):
        with pytest.raises(ValueError):
            read_target(spark, other)
        with pytest.raises(ValueError):
            publish(_rows(spark, [("k1", 6, "x", False)]), other, "update")
    # a new table may be split anew
    publish(_rows(spark, [("a", 1, "a1", False)]), Target(target.root, "id", "version", buckets=7), "recreate")
    assert _state(spark, same) == {"a": "a1"} and current(spark, same).buckets == 7


def test_repeated_keys_are_folded_the_same_every_time(spark, target):
    rows = [("a", 1, "x", False), ("a", 2, "y", False), ("b", 3, "p", False), ("b", 3, "q", False), ("b", 3, "o", False)]
    for mode in ("recreate", "update"):
        for order in (rows, rows[::-1]):
            publish(_rows(spark, order).repartition(3), target, mode)
            assert _state(spark, target) == {"a": "y", "b": "q"}


def test_one_key_is_read_from_its_bucket(spark, target):
    publish(_rows(spark, [(f"k{i}", 0, f"v{i}", False) for i in range(40)]), target, "recreate")
    found = read_target(spark, target, key="k7")
    assert [r["kirje"] for r in found.collect()] == ["v7"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan


def test_drop_and_wrong_use(spark, target):
    drop_target(spark, target)  # nothing there
    publish(_rows(spark, [("a", 1, "a1", False)]), target, "recreate")
    with pytest.raises(ValueError):
        publish(_rows(spark, []), target, "replace")
    with pytest.raises(ValueError):
        publish(_rows(spark, [("a", 1, "x", False)]).drop("kirje"), target, "update")
    drop_target(spark, target)
    with pytest.raises(ValueError):
        read_target(spark, target)
    publish(_rows(spark, [("b", 1, "b1", False)]), target, "update")
    assert _state(spark, target) == {"b": "b1"}


def _person(spark, rows):
    from personpub.operators.persons import fill_defaults
    from personpub.schemas import FLAGS, PERSON_COLUMNS

    df = spark.createDataFrame(rows, "persoon string, kirje string, updated string")
    rest = [c for c in PERSON_COLUMNS if c not in ("persoon", "kirje", "updated")]
    return fill_defaults(
        df.select(
            "persoon", "kirje", F.col("updated").cast("timestamp_ntz").alias("updated"),
            *[F.lit(None).cast("boolean" if c in FLAGS else "string").alias(c) for c in rest],
        )
    )


def test_increments(spark, tmp_path):
    target = Target(str(tmp_path / "doc"), key="id", version="updated", buckets=2)
    rows = [("1", "one", "2024-01-01 10:00:00"), ("2", "two", "2024-01-01 10:00:05")]
    first = run_increment(_person(spark, rows), target)
    assert (first.status, first.last, first.new) == ("published", None, "2024-01-01 10:00:05")
    assert run_increment(_person(spark, rows), target).status == "no news"
    # a late row of the mark's second is found with an overlap only
    rows += [("3", "three", "2024-01-01 10:00:05"), ("1", "", "2024-01-01 10:00:09")]
    rows = rows[1:]
    assert run_increment(_person(spark, rows), target, overlap=1).status == "published"
    assert _state(spark, target) == {"2": "two", "3": "three"}
    rows += [("4", None, "2024-01-01 10:00:20"), ("5", "five", "2024-01-01 10:00:21")]
    run_increment(_person(spark, rows), target, null_deletes=False)
    assert _state(spark, target) == {"2": "two", "3": "three", "4": None, "5": "five"}
    with pytest.raises(ValueError):
        run_increment(_person(spark, rows), target, mode="recreate")
    with pytest.raises(RuntimeError):
        run_increment(_person(spark, []), target)


def test_mark_does_not_move_when_the_merge_fails(spark, tmp_path, monkeypatch):
    target = Target(str(tmp_path / "doc"), key="id", version="updated", buckets=2)
    run_increment(_person(spark, [("1", "one", "2024-01-01 10:00:00")]), target)
    rows = [("1", "one", "2024-01-01 10:00:00"), ("2", "two", "2024-01-01 11:00:00")]

    def fail(*_):
        raise OSError("disk")

    with monkeypatch.context() as patch:
        patch.setattr(targets, "_write", fail)
        with pytest.raises(OSError):
            run_increment(_person(spark, rows), target)
    assert current(spark, target).mark == "2024-01-01 10:00:00"
    run_increment(_person(spark, rows), target)
    assert _state(spark, target) == {"1": "one", "2": "two"}


def test_stream_ends_as_batch(spark, tmp_path):
    rng = random.Random(11)
    rows = [(f"k{rng.randrange(12)}", i, f"v{i}", rng.random() < 0.2) for i in range(80)]
    rng.shuffle(rows)  # late rows
    source = str(tmp_path / "source")
    for part in range(4):
        _rows(spark, rows[part * 20:(part + 1) * 20]).coalesce(1).write.mode("append").parquet(
            source
        )
    target = Target(str(tmp_path / "doc"), key="id", version="version", buckets=2)

    def run(name):
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(source)
        stream_publish(stream, target, str(tmp_path / name), "s").awaitTermination()

    run("checkpoint")
    last = {}
    for key, version, text, gone in sorted(rows, key=lambda r: r[1]):
        last[key] = None if gone else text
    want = {k: v for k, v in last.items() if v is not None}
    assert _state(spark, target) == want
    assert current(spark, target).batches == {"s": 3}
    files = _files(target)
    run("other-checkpoint")  # the same batches again, by their numbers
    assert _files(target) == files
    assert _state(spark, target) == want


def test_backup(spark, tmp_path):
    from personpub.plans.backup import backup
    from personpub.sources.bindings import load
    from personpub.sources.outputs import restore

    views = [load(spark, "/root/testdata/sf0.001", v) for v in ("v_record", "v_person", "v_register")]
    for day in (1, 2):
        run = datetime(2024, 3, day)
        backup(*views, {"record": views[0]}, str(tmp_path), run)
    assert spark.read.parquet(f"{tmp_path}/statistics").count() == 2
    assert restore(spark, str(tmp_path), "record", run).count() == views[0].count()


def test_marks_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "mark")
    assert load_mark(spark, path) is None
    save_mark(spark, path, "2024-01-01 10:00:00")
    save_mark(spark, path, "2024-01-01 09:00:00")
    assert load_mark(spark, path) == "2024-01-01 09:00:00"
    run = datetime(2024, 3, 1)
    snapshot(spark.range(3), str(tmp_path), "t", run)
    with pytest.raises(Exception):
        snapshot(spark.range(3), str(tmp_path), "t", run)
