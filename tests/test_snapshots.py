"""Snapshot tables: atomic commits, merges of touched partitions, change log, key index, marks, catalog."""

import pytest
from pyspark.sql import functions as F

from tillstream.operators import merge
from tillstream.sources import snapshots as sn

LAYOUT = "k string, v int, d int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), LAYOUT)


def state(spark, path, **options):
    return sorted(tuple(r) for r in sn.read(spark, path, **options).collect())


def put(spark, path, *rows, **options):
    return sn.upsert(spark, path, frame(spark, *rows), "k", ["d"], ["v"], lambda s, t: s("v") != t("v"), **options)


def test_upsert_touches_its_partitions_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    one = put(spark, path, ("a", 1, 1), ("b", 2, 1), ("c", 3, 2), (None, 9, 3))
    two = put(spark, path, ("a", 5, 2), ("c", 3, 2), ("x", 7, 2))  # a lives in 1 and stays there, c is as it was
    assert {tuple(r) for r in sn.read(spark, path).collect()} == {("a", 5, 1), ("b", 2, 1), ("c", 3, 2), ("x", 7, 2), (None, 9, 3)}
    assert two.parts["d=1"] != one.parts["d=1"] and len(two.parts["d=1"]) == 1  # rewritten
    assert two.parts["d=2"][0] == one.parts["d=2"][0] and len(two.parts["d=2"]) == 2  # added to
    assert two.parts["d=3"] == one.parts["d=3"] and set(two.changed) == {"d=1", "d=2"}
    assert sorted(tuple(r) for r in sn.changes(spark, path, 1).collect()) == [("insert", 2, "x", 7, 2), ("update", 2, "a", 5, 1)]
    assert {tuple(r) for r in sn.read(spark, path, snapshot=one).collect()} == {("a", 1, 1), ("b", 2, 1), ("c", 3, 2), (None, 9, 3)}
    same = put(spark, path, ("a", 5, 1))
    assert same.parts == two.parts and same.changed == () and sn.changes(spark, path, 2).isEmpty()


def test_merge_equals_the_plain_one(spark, tmp_path):
    """Loads one after another against the full outer join of the whole table; the log against the difference of versions."""
    path, plain = f"{tmp_path}/t", frame(spark)
    for n in range(4):
        rows = [(f"k{i}", (i * n) % 5, i % 4 if n % 2 else (i + 1) % 4) for i in range(10 * n, 10 * n + 25)]
        before = plain
        plain = merge.merge_upsert(plain, frame(spark, *rows), "k", ["v"], lambda s, t: s("v") != t("v"))
        plain = spark.createDataFrame(plain.collect(), LAYOUT)
        put(spark, path, *rows)
        assert state(spark, path) == sorted(tuple(r) for r in plain.collect())
        feed = sorted((r.change, r.k, r.v, r.d) for r in merge.changes(before, plain, "k").collect())
        assert sorted((r.change, r.k, r.v, r.d) for r in sn.changes(spark, path, n).collect()) == feed
    assert sorted(r.k for r in sn.latest_changes(spark, path, "k", 0).collect()) == sorted(r.k for r in plain.collect())


@pytest.mark.parametrize("step", ["_write", "_written_parts", "_new_index", "commit"])
def test_a_load_killed_at_any_step_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    path, calls = f"{tmp_path}/t", []
    put(spark, path, ("a", 1, 1), ("b", 2, 2))
    kept = getattr(sn, step)

    def killed(*args, **kwargs):
        calls.append(step)
        if len(calls) == (2 if step == "_write" else 1):  # the data, after the log
            raise KeyboardInterrupt
        return kept(*args, **kwargs)

    monkeypatch.setattr(sn, step, killed)
    with pytest.raises(KeyboardInterrupt):
        put(spark, path, ("a", 5, 1), ("c", 3, 3))
    monkeypatch.undo()
    assert sn.load(spark, path).version == 1 and state(spark, path) == [("a", 1, 1), ("b", 2, 2)]
    assert put(spark, path, ("a", 5, 1), ("c", 3, 3)).version == 2
    assert state(spark, path) == [("a", 5, 1), ("b", 2, 2), ("c", 3, 3)]
    gone = sn.expire(spark, path, keep=1, grace_seconds=-10)
    assert any(g.startswith("work/") for g in gone) and any(g.startswith("log/") for g in gone)
    assert state(spark, path) == [("a", 5, 1), ("b", 2, 2), ("c", 3, 3)] and sn.versions(spark, path) == [2]
    with pytest.raises(sn.Expired):
        sn.changes(spark, path, 0)


def test_two_writers_do_not_both_commit(spark, tmp_path, monkeypatch):
    path, late = f"{tmp_path}/t", []
    put(spark, path, ("a", 1, 1))
    commit = sn.commit

    def slow(*args):
        if not late:
            late.append(1)
            put(spark, path, ("b", 2, 1))  # another load gets there first
        return commit(*args)

    monkeypatch.setattr(sn, "commit", slow)
    with pytest.raises(sn.Conflict):
        put(spark, path, ("c", 3, 1))
    assert state(spark, path) == [("a", 1, 1), ("b", 2, 1)]


def test_replace_logs_what_changed(spark, tmp_path):
    path = f"{tmp_path}/t"
    options = dict(columns=["d"], key="k", but=["at"], index="k")
    rows = lambda at, *r: frame(spark, *r).withColumn("at", F.lit(at))
    sn.replace(spark, path, rows(1, ("a", 1, 1), ("b", 2, 1), ("c", 3, 2), ("e", 1, None)), **options)
    assert {(r.change, r.k) for r in sn.changes(spark, path, 0).collect()} == {("insert", k) for k in "abce"}
    # day 1 anew: a as it was, b moved to day 2, f new; day 2 keeps c
    s = sn.replace(spark, path, rows(2, ("a", 1, 1), ("f", 6, 1), ("b", 2, 2), ("c", 3, 2)), parts=["d=1", "d=2"], **options)
    assert {(r.change, r.k, r.d) for r in sn.changes(spark, path, 1).collect()} == {("update", "b", 2), ("insert", "f", 1)}
    s = sn.replace(spark, path, rows(3, ("a", 1, 1)), parts=["d=1"], **options)
    assert {(r.change, r.k, r.d) for r in sn.changes(spark, path, 2).collect()} == {("delete", "f", 1)}
    assert {r.k: r.home for r in sn.homes(spark, path, frame(spark, *[(k, 0, 0) for k in "abcexyz"]), "k").collect() if r.k != "f"} == {
        "a": "d=1", "b": "d=2", "c": "d=2", "e": f"d={sn.NO_VALUE}"}
    assert {r.k for r in sn.read(spark, path, [f"d={sn.NO_VALUE}"]).collect()} == {"e"}
    with pytest.raises(ValueError, match="outside"):
        sn.replace(spark, path, rows(4, ("c", 3, 2)), parts=["d=1"], **options)
    s = sn.replace(spark, path, rows(5, ("a", 1, 1)).limit(0), parts=["d=1"], marks={"m": 3}, **options)
    assert "d=1" not in s.parts and sn.load(spark, path).marks == {"m": 3}


def test_index_files_do_not_grow_with_the_days(spark, tmp_path, monkeypatch):
    """Every load brings a new day and a late version of one key; the days opened stay the same, so do the index folders."""
    monkeypatch.setattr(sn, "MOST_INDEX", 3)
    path, days, folders = f"{tmp_path}/t", [], []
    for n in range(8):
        put(spark, path, *[(f"{n}-{i}", 0, n) for i in range(5)])
        s = sn.load(spark, path)
        late = frame(spark, (f"{n}-1", 9, n), (f"{max(0, n - 1)}-2", 9, n))
        days.append(len({r.home for r in sn.homes(spark, path, late, "k", s).collect()}))
        folders.append(len(s.index))
    assert days[1:] == [2] * 7 and max(folders) <= 3
    assert {r.home for r in sn.homes(spark, path, frame(spark, ("0-3", 0, 0)), "k").collect()} == {"d=0"}


def test_many_small_folders_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sn, "MOST_FOLDERS", 3)
    path = f"{tmp_path}/t"
    counts = [len(put(spark, path, (f"k{n}", n, 1)).parts["d=1"]) for n in range(5)]
    assert counts == [1, 2, 3, 1, 2] and len(state(spark, path)) == 5


def test_published_partitions_follow_the_commits(spark, tmp_path):
    path, table = f"{tmp_path}/t", "published_t"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    sn.replace(spark, path, frame(spark, ("a", 1, 1), ("b", 2, 2), ("n", 3, None)), ["d"])
    assert len(sn.publish(spark, table, path)) == 3 and spark.table(table).count() == 3
    sn.replace(spark, path, frame(spark, ("a", 5, 1), ("c", 5, 3)), ["d"], ["d=1", "d=3"])
    sn.replace(spark, path, frame(spark).limit(0), ["d"], ["d=2"])
    assert sn.publish(spark, table, path) == ["d=1", "d=2", "d=3"] and sn.publish(spark, table, path) == []
    assert {tuple(r) for r in spark.table(table).collect()} == {("a", 5, 1), ("c", 5, 3), ("n", 3, None)}
    assert {tuple(r) for r in spark.table(table).where("d = 1").collect()} == {("a", 5, 1)}
    for v in range(2):
        sn.replace(spark, f"{path}2", frame(spark, ("a", v, 1)))
        sn.publish(spark, f"{table}2", f"{path}2")
        assert [r.v for r in spark.table(f"{table}2").collect()] == [v]
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"DROP TABLE {table}2")


@pytest.mark.parametrize("way", ["upsert", "replace"])
def test_an_index_is_made_for_a_table_without_one(spark, tmp_path, way):
    path = f"{tmp_path}/t"
    sn.replace(spark, path, frame(spark, ("a", 1, 1), ("b", 2, 2), ("c", 3, 3)), ["d"])
    if way == "upsert":
        put(spark, path, ("a", 5, 2), ("x", 1, 2))
    else:
        sn.replace(spark, path, frame(spark, ("a", 5, 1)), ["d"], ["d=1"], index="k", placed=frame(spark, ("a", 5, 1)))
        put(spark, path, ("x", 1, 2))
    put(spark, path, ("b", 7, 9), ("c", 3, 1))
    assert state(spark, path) == [("a", 5, 1), ("b", 7, 2), ("c", 3, 3), ("x", 1, 2)]


def test_rows_move_when_a_partition_column_is_updated(spark, tmp_path):
    path = f"{tmp_path}/t"
    differs = lambda s, t: (s("v") != t("v")) | (s("d") != t("d"))
    for rows in ([("a", 1, 1), ("b", 2, 1)], [("a", 1, 2)], [("a", 3, 1), ("c", 1, 2)]):
        s = sn.upsert(spark, path, frame(spark, *rows), "k", ["d"], ["v", "d"], differs)
    assert state(spark, path) == [("a", 3, 1), ("b", 2, 1), ("c", 1, 2)] and set(s.changed) == {"d=1", "d=2"}
    assert [(r.change, r.k, r.d) for r in sn.changes(spark, path, 1, 2).collect()] == [("update", "a", 2)]
