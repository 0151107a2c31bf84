import datetime
import os
import random
import statistics
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricegrid.functions.records import with_fields
from pricegrid.operators.reconcile import bag_except, bag_intersect, differences, reconciled
from pricegrid.operators.states import RANK_ERROR, daily_states, stats_of_states
from pricegrid.session import scratch_dir, stage
from pricegrid.streaming.windows import daily_prices, late_rows, open_days, stream_daily_prices

DAY = datetime.date(2020, 1, 1)


def bags(spark):
    pick = random.Random(2)
    rows = [[(pick.choice(["a", "b", None]), pick.choice([1, 2, None])) for _ in range(n)] for n in (60, 45)]
    rows[0] += [("only left", 1)] * 3
    return rows, [spark.createDataFrame(r, "k string, `a.b` int") for r in rows]


def test_bags(spark):
    rows, (left, right) = bags(spark)
    a, b = map(Counter, rows)
    told = lambda df: Counter(tuple(r) for r in df.collect())
    assert told(bag_except(left, right)) == a - b and told(bag_except(right, left)) == b - a
    assert told(bag_intersect(left, right)) == a & b
    assert told(bag_except(left, right)) == told(left.exceptAll(right))
    assert {(r["k"], r["a.b"]): (r.n_lost, r.n_extra) for r in differences(left, right).collect()} == {
        k: (max(a[k] - b[k], 0), max(b[k] - a[k], 0)) for k in a | b if a[k] != b[k]
    }
    sums = {r.k: (r.n_left, r.n_right, r.n_same, r.n_lost, r.n_extra) for r in reconciled(left, right, ["k"]).collect()}
    assert sums["only left"] == (3, 0, 0, 3, 0)
    assert sum(s[2] for s in sums.values()) == (a & b).total()
    none = left.limit(0)
    assert bag_except(none, left).count() == 0 and bag_except(left, none).count() == left.count()


def test_fields_of_records(spark):
    texts = ['{"k": 5, "d": {"x": [1, 2.5]}}', '{"k": "7"}', '{"k": "seven"}', '{"k": null}', "{}", '{"k": 5', "", None, "[1]", '{"k": [1]}', '{"k": 5.0}', '{"d": {"x": 1}}']
    feed = spark.createDataFrame(list(enumerate(texts)), "n int, props string")
    got = with_fields(feed, "props", {"k": ("$.k", "int"), "x": ("$.d.x[1]", "double")})
    rows = {r.n: r for r in got.collect()}
    assert [rows[i].k for i in range(12)] == [5, 7, None, None, None, None, None, None, None, None, 5, None]
    assert [i for i in rows if rows[i].props_broken] == [5, 6]
    assert [i for i in rows if rows[i].k_mistyped] == [2, 9]
    assert (rows[0].x, rows[11].x, rows[11].x_mistyped) == (2.5, None, False)
    assert "props" in got.columns and "props_variant" not in got.columns


def test_statistics_of_a_range_from_states(spark):
    pick = random.Random(6)
    rows = [(pick.choice("ab"), DAY + datetime.timedelta(pick.randrange(40)), Decimal(round(10**9 + pick.gauss(0, 3), 4)).quantize(Decimal("0.0001"))) for _ in range(8000)]
    rows += [("one", DAY, Decimal(5)), ("a", DAY, None)]
    states = stage(daily_states(spark.createDataFrame(rows, "k string, start_date date, price decimal(18,4)"), ["k"]), "states")
    assert states.count() <= 81
    first, last = DAY + datetime.timedelta(5), DAY + datetime.timedelta(29)
    merged = stats_of_states(states.filter(F.col("start_date").between(first, last)), ["k"], (0.1, 0.5, 0.9))
    assert "states" in merged.inputFiles()[0]
    for r in merged.collect():
        own = sorted(p for k, d, p in rows if k == r.k and first <= d <= last)
        assert (r.n, r.min_price, r.max_price) == (len(own), own[0], own[-1])
        assert r.avg_price == pytest.approx(float(sum(own) / len(own)), abs=1e-6)
        assert r.stddev_price == pytest.approx(statistics.stdev(map(float, own)), rel=1e-6)
        for q, value in ((0.1, r.q_10), (0.5, r.q_50), (0.9, r.q_90)):
            rank = sum(float(p) <= value for p in own) / len(own)
            assert abs(rank - q) <= RANK_ERROR + 1 / len(own)
    [one] = stats_of_states(states.filter("k = 'one'"), ["k"]).collect()
    assert (one.n, one.stddev_price, one.q_50) == (1, None, 5.0)


PRICES = "dataset string, vendor string, price decimal(18,4), ts timestamp"


def price_stream(spark, batches):
    root = scratch_dir(spark, "in")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, PRICES).coalesce(1).write.parquet(f"{root}/{i}")
        for name in os.listdir(f"{root}/{i}"):
            os.utime(f"{root}/{i}/{name}", (1_600_000_000 + i, 1_600_000_000 + i))
    return spark.readStream.schema(PRICES).option("maxFilesPerTrigger", 1).parquet(f"{root}/*"), spark.read.schema(PRICES).parquet(f"{root}/*")


def test_days_of_a_stream_equal_the_batch(spark):
    pick, at = random.Random(3), lambda hours: datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=hours)
    batches = [
        [(pick.choice("de"), pick.choice("vw"), Decimal(pick.randrange(1, 900)), at(24 * i + pick.randrange(0, 30))) for _ in range(40)] for i in range(8)
    ]
    batches[2].append(("d", "v", Decimal(1), None))
    stream, batch = price_stream(spark, batches)
    out, state = scratch_dir(spark, "out"), scratch_dir(spark, "state")
    query = stream_daily_prices(stream, "12 hours", out, state)
    written, still = spark.read.parquet(out), open_days(spark, state)
    want = {tuple(r) for r in daily_prices(batch).collect()}
    closed = {w for w in want if w[0] <= DAY + datetime.timedelta(6)}
    assert {tuple(r) for r in written.collect()} == closed and len(closed) == written.count() > 20
    assert {(r.day, r.dataset, r.vendor, r.n) for r in still.collect()} == {w[:4] for w in want - closed}
    assert late_rows(batch, written, still).collect() == []
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(held) <= 12


def test_late_rows_are_told(spark):
    at = lambda hours: datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=hours)
    # the second batch writes the first day, the third one comes too late for it
    batches = [
        [("d", "v", Decimal(1), at(1)), ("d", "v", Decimal(2), at(60))],
        [("d", "w", Decimal(4), at(50))],
        [("d", "v", Decimal(3), at(2))] * 3 + [("d", "w", Decimal(6), at(51))],
        [("d", "v", Decimal(5), at(90))],
    ]
    stream, batch = price_stream(spark, batches)
    out, state = scratch_dir(spark, "out"), scratch_dir(spark, "state")
    stream_daily_prices(stream, "12 hours", out, state)
    written, still = spark.read.parquet(out), open_days(spark, state)
    assert {(r.day.day, r.vendor, r.n_late) for r in late_rows(batch, written, still).collect()} == {(1, "v", 3)}
    assert sum(r.n for r in written.collect()) + sum(r.n for r in still.collect()) + 3 == batch.count()
