from datetime import timedelta

import pytest

from rowsmith.session import list_folders
from rowsmith.sources import log as L
from rowsmith.sources.log import AppendLog

SCHEMA = "name string, n bigint, write_id string"


@pytest.fixture
def log(spark, tmp_path):
    return AppendLog(spark, str(tmp_path / "log"), SCHEMA, "write_id")


def add(log, *values):
    log.append(log.spark.createDataFrame([(f"r{v}", v) for v in values], "name string, n bigint"))


def held(log):
    rows = log.rows()
    assert rows.columns == ["name", "n", "write_id"]
    return sorted(r["n"] for r in rows.collect())


def folders(log):
    return len(list_folders(log.spark, f"{log.path}/*"))


def snapshots(log):
    return len(list_folders(log.spark, f"{log.beside}/data/*"))


def test_snapshot_and_tail(log):
    assert held(log) == [] and log.compact() == 0 and snapshots(log) == 0
    add(log, 1, 2)
    add(log, 3)
    log.compact()
    assert (held(log), folders(log), snapshots(log)) == ([1, 2, 3], 2, 1)
    add(log, 4)
    assert held(log) == [1, 2, 3, 4]
    log.compact()  # replaced writes and snapshots stay for the retention time
    assert (held(log), folders(log), snapshots(log)) == ([1, 2, 3, 4], 3, 2)
    assert log.compact(timedelta(0)) == 4
    assert (held(log), folders(log), snapshots(log)) == ([1, 2, 3, 4], 0, 1)
    assert log.compact(timedelta(0)) == 0 and held(log) == [1, 2, 3, 4]


def test_a_reader_survives_a_compaction(log):
    add(log, 1)
    add(log, 2)
    before = log.rows()
    log.compact()
    log.compact()
    assert sorted(r["n"] for r in before.collect()) == [1, 2]


@pytest.mark.parametrize("step", ["mark", "marks"])
def test_a_crash_loses_nothing(log, monkeypatch, step):
    add(log, 1)
    log.compact(timedelta(0))
    add(log, 2)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "mark":
            m.setattr(L, "create_exclusively", fail)
        else:
            m.setattr(type(log), "_marks", fail)
        with pytest.raises(RuntimeError):
            log.compact(timedelta(0))
    assert held(log) == [1, 2]
    log.compact(timedelta(0))
    assert (held(log), folders(log), snapshots(log)) == ([1, 2], 0, 1)


def test_a_crash_between_mark_and_sweep_loses_nothing(log, monkeypatch):
    add(log, 1)
    add(log, 2)
    with monkeypatch.context() as m:
        m.setattr(type(log), "_sweep", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.compact()
    assert (held(log), folders(log), snapshots(log)) == ([1, 2], 2, 1)


def test_two_compactions_at_once(log):
    """Both look before either is done; each sees another part of the writes."""
    add(log, 1)
    first = log.rows().select("write_id").distinct().collect()
    add(log, 2, 3)
    every = log.rows().select("write_id").distinct()
    log._snapshot([], log.spark.createDataFrame(first, "write_id string"))
    log._snapshot([], every)
    add(log, 4)
    assert held(log) == [1, 2, 3, 4] and snapshots(log) == 2
    log.compact(timedelta(0))
    assert (held(log), folders(log), snapshots(log)) == ([1, 2, 3, 4], 0, 1)


def test_an_unfinished_write_waits(log):
    add(log, 1)
    add(log, 2)
    path = list_folders(log.spark, f"{log.path}/*")[0][0].replace("file:", "")
    import os

    os.remove(f"{path}/_SUCCESS")
    log.compact(timedelta(0))
    assert held(log) == [1, 2] and folders(log) == 1
