import datetime
import os
from decimal import Decimal

import pytest

from pricegrid.session import scratch_dir
from pricegrid.sinks import snapshots
from pricegrid.sinks.snapshots import append_rows, expire, read_snapshot, reload_range, snapshot

DAY = datetime.date(2020, 1, 1)
ROWS = "id string, dataset string, start_date date, price decimal(18,4)"


def day(i):
    return DAY + datetime.timedelta(i)


def rows(spark, days, price, dataset="a b+c/d%e"):
    return spark.createDataFrame([(f"{dataset}{i}", dataset, None if i is None else day(i), Decimal(price)) for i in days], ROWS)


def told(df):
    return sorted((r.dataset or "", str(r.start_date), int(r.price)) for r in df.collect())


def test_a_reload_replaces_the_range(spark):
    path = scratch_dir(spark, "s")
    append_rows(spark, path, rows(spark, [*range(6), None], 1).unionByName(rows(spark, [2, 5], 1, None)))
    append_rows(spark, path, rows(spark, [2], 1, "second load of a day"))
    want = sorted(
        [("a b+c/d%e", str(day(i)), 1) for i in (0, 1, 5)] + [("a b+c/d%e", "None", 1), ("", str(day(5)), 1), ("x", str(day(3)), 2)]
    )
    for _ in range(2):
        reload_range(spark, path, rows(spark, [1, 3, 5], 2, "x"), day(2), day(4))
        assert told(read_snapshot(spark, path)) == want
    part = read_snapshot(spark, path, day(3), day(5))
    assert told(part) == [w for w in want if str(day(3)) <= w[1] <= str(day(5))]
    read = part.select("price")._jdf.queryExecution().executedPlan().toString()
    assert len(set(part.inputFiles())) == 3 and str(day(0)) not in read
    assert told(read_snapshot(spark, path, number=0))[0][2] == 1 and len(told(read_snapshot(spark, path, number=0))) == 9


@pytest.mark.parametrize("step", ["_write_rows", "_publish"])
def test_readers_see_the_old_load_until_the_new_one_is_whole(spark, monkeypatch, step):
    """The load stops after its rows are written, and before its snapshot is put in place."""
    path = scratch_dir(spark, "s")
    append_rows(spark, path, rows(spark, range(4), 1))
    before, open_ = told(read_snapshot(spark, path)), read_snapshot(spark, path)
    real = getattr(snapshots, step)

    def stopped(*args):
        if step == "_write_rows":
            real(*args)
        assert told(read_snapshot(spark, path)) == before
        raise OSError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, step, stopped)
        with pytest.raises(OSError):
            reload_range(spark, path, rows(spark, [1], 2), day(0), day(3))
    assert told(read_snapshot(spark, path)) == before
    reload_range(spark, path, rows(spark, [1], 2), day(0), day(3))
    assert told(read_snapshot(spark, path)) == [("a b+c/d%e", str(day(1)), 2)]
    # who had begun to read goes on with the old load, until it is cleared away
    assert told(open_) == before
    expire(spark, path)
    assert len(os.listdir(f"{path}/rows")) == len(os.listdir(f"{path}/manifests")) == 1
    assert told(read_snapshot(spark, path)) == [("a b+c/d%e", str(day(1)), 2)]


def test_two_loads_at_a_time(spark, monkeypatch):
    """Another load takes the number first: both count in the end."""
    path = scratch_dir(spark, "s")
    append_rows(spark, path, rows(spark, range(3), 1))
    real, others = snapshots._publish, [rows(spark, [0], 7, "other")]

    def late(spark_, path_, at):
        if others:
            other = others.pop()
            assert reload_range(spark, path, other, day(0), day(0)).number == 1
        return real(spark_, path_, at)

    monkeypatch.setattr(snapshots, "_publish", late)
    assert reload_range(spark, path, rows(spark, [2], 5, "mine"), day(2), day(2)).number == 2
    assert told(read_snapshot(spark, path)) == [("a b+c/d%e", str(day(1)), 1), ("mine", str(day(2)), 5), ("other", str(day(0)), 7)]


def test_nothing_there_and_nothing_left(spark):
    path = scratch_dir(spark, "s")
    assert snapshot(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    append_rows(spark, path, rows(spark, [], 1))
    assert read_snapshot(spark, path).collect() == []
    append_rows(spark, path, rows(spark, [1, 2], 1))
    reload_range(spark, path, rows(spark, [7], 1), day(0), day(4))
    left = read_snapshot(spark, path)
    assert left.collect() == [] and left.schema.simpleString() == rows(spark, [], 1).schema.simpleString()
