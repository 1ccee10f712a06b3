"""Stored tables: atomic versions, the commit log, replayed batches."""

import datetime as dt

import pytest

from lodestar.sources import tables as T
from lodestar.streaming.incremental import after_mark, incremental_append, stream_incremental


def rows(spark, lo, hi):
    return spark.createDataFrame([(i, dt.date(2024, 1, 1) + dt.timedelta(days=i // 5) if i % 7 else None)
                                  for i in range(lo, hi)], "k long, d date")


def keys(df):
    return sorted(r.k for r in df.select("k").collect())


class Killed(RuntimeError):
    pass


def kill_at(monkeypatch, name, number, after=False):
    """The function ``name`` of tables dies at its n-th call (or right after)."""
    real, calls = getattr(T, name), []

    def dying(*a, **kw):
        calls.append(1)
        if len(calls) == number:
            if after:
                real(*a, **kw)
            raise Killed(name)
        return real(*a, **kw)

    monkeypatch.setattr(T, name, dying)


def test_append_and_replace(spark, scratch):
    path = scratch("t")
    assert T.read_table(spark, path) is None and not T.table_exists(spark, path)
    T.append_load(rows(spark, 0, 20), path, "d")
    T.append_load(rows(spark, 20, 30), path, "d")
    t = T.read_table(spark, path)
    assert t.columns == ["k", "d"] and keys(t) == list(range(30))
    assert sorted(map(str, (tuple(r) for r in t.collect()))) == sorted(map(str, (tuple(r) for r in rows(spark, 0, 30).collect())))
    new = T.replace_table(t.where("k < 5"), path, partition_col="d")  # reads the version it replaces
    assert keys(new) == list(range(5)) == keys(T.read_table(spark, path))
    assert keys(t) == list(range(30))  # a reader of the old version still sees it whole


@pytest.mark.parametrize("name,after", [("_write_load", False), ("_write_load", True), ("_commit", False)])
def test_a_killed_write_leaves_the_table(spark, scratch, monkeypatch, name, after):
    path = scratch("t")
    with monkeypatch.context() as m:  # the very first write dies
        kill_at(m, name, 1, after)
        with pytest.raises(Killed):
            T.append_load(rows(spark, 0, 10), path, "d", taken=["a"])
    assert T.read_table(spark, path) is None and T.not_taken(spark, path, ["a"]) == ["a"]
    T.append_load(rows(spark, 0, 10), path, "d", taken=["a"])
    for write in (T.append_load, T.replace_table):
        with monkeypatch.context() as m:
            kill_at(m, name, 1, after)
            with pytest.raises(Killed):
                write(rows(spark, 10, 20), path, taken=["b"])
        assert keys(T.read_table(spark, path)) == list(range(10)) and T.not_taken(spark, path, ["a", "b"]) == ["b"]
    T.append_load(rows(spark, 10, 20), path, "d", taken=["b"])
    assert keys(T.read_table(spark, path)) == list(range(20))
    gone = T.vacuum(spark, path)
    assert len(gone) == (2 + 1 if after or name == "_commit" else 0)
    assert keys(T.read_table(spark, path)) == list(range(20))


def test_a_half_written_folder_hides_nothing(spark, scratch):
    path = scratch("t")
    rows(spark, 0, 9).write.parquet(f"{path}/{T.LOAD}=w0")  # files of a dead writer
    assert T.read_table(spark, path) is None
    T.append_load(rows(spark, 0, 3), path)
    assert keys(T.read_table(spark, path)) == [0, 1, 2]


def test_a_batch_is_taken_in_once(spark, scratch):
    path = scratch("t")
    assert T.append_once(rows(spark, 0, 5), path, "d", "batch-1")
    assert not T.append_once(rows(spark, 0, 5), path, "d", "batch-1")
    assert T.append_once(rows(spark, 0, 5), path, "d", "batch-2")  # same rows, another batch
    assert keys(T.read_table(spark, path)) == sorted(list(range(5)) * 2)
    T.compact_table(spark, path)
    assert not T.append_once(rows(spark, 0, 5), path, "d", "batch-2")
    assert len(T.current_version(spark, path).loads) == 1 and T.read_table(spark, path).count() == 10


def test_two_writers_of_one_version(spark, scratch):
    path = scratch("t")
    T.append_load(rows(spark, 0, 5), path)
    old = T.current_version(spark, path)
    T.append_load(rows(spark, 5, 6), path)
    with pytest.raises(T.ConcurrentWrite):
        T._commit(spark, path, T.Version(old.number + 1, old.schema, None, old.loads, []))
    assert keys(T.read_table(spark, path)) == list(range(6))


def test_empty_loads(spark, scratch):
    path = scratch("t")
    T.append_load(rows(spark, 0, 0), path, "d", taken=["none"])
    t = T.read_table(spark, path)
    assert t.columns == ["k", "d"] and t.count() == 0 and T.not_taken(spark, path, ["none"]) == []
    assert keys(after_mark(rows(spark, 0, 4), "d", t, "d", empty_loads_all=True)) == [0, 1, 2, 3]
    incremental_append(spark, rows(spark, 0, 4), path, "d")  # an empty target still loads
    assert keys(T.read_table(spark, path)) == [0, 1, 2, 3]


def test_replayed_micro_batch_appends_nothing(spark, scratch, monkeypatch):
    src, path, chk = scratch("src"), scratch("t"), scratch("chk")
    rows(spark, 0, 10).write.parquet(f"{src}/a")
    schema = rows(spark, 0, 1).schema
    # the batch is committed to the table, then the stream dies before its own log
    import lodestar.streaming.incremental as I
    real = I.append_once

    def dying(*a):
        real(*a)
        raise Killed("after the commit")

    with monkeypatch.context() as m:
        m.setattr(I, "append_once", dying)
        with pytest.raises(Exception, match="after the commit"):
            stream_incremental(spark, src + "/*", schema, path, "d", chk)
    assert keys(T.read_table(spark, path)) == list(range(10))
    stream_incremental(spark, src + "/*", schema, path, "d", chk)  # replays the batch
    assert keys(T.read_table(spark, path)) == list(range(10))
    rows(spark, 3, 6).write.parquet(f"{src}/b")  # late rows are a batch like any other
    stream_incremental(spark, src + "/*", schema, path, "d", chk)
    assert keys(T.read_table(spark, path)) == sorted([*range(10), 3, 4, 5])
