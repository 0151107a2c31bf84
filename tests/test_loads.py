import datetime
import os
from decimal import Decimal
from functools import reduce
from operator import and_
from random import Random

import pytest
from pyspark.sql import functions as F

from pricegrid import schemas
from pricegrid.functions.prices import observation_id, parse_price
from pricegrid.plans import queries
from pricegrid.session import scratch_dir
from pricegrid.sinks import database
from pricegrid.sinks.files import write_archive, write_feed, write_report_csv
from pricegrid.sinks.reload import replace_range, replaced
from pricegrid.sources.tables import read_archive, read_feed, stream_feed
from pricegrid.streaming import load
from pricegrid.streaming.load import load_increment
from pricegrid.streaming.repeats import key_text, stream_without_repeats

DAY = datetime.date(2020, 1, 1)
ROWS = "id string, dataset string, start_date date, price decimal(18,4)"


def day(i):
    return DAY + datetime.timedelta(i)


def archive_rows(spark, days, price, dataset="a b/c"):
    return spark.createDataFrame([(f"{dataset}{i}", dataset, day(i), Decimal(price)) for i in days], ROWS)


def told(df):
    return sorted((r.id, r.dataset, r.start_date, r.price) for r in df.collect())


def test_reload_replaces_the_range_and_drops_vanished_days(spark):
    path = scratch_dir(spark, "t")
    old = archive_rows(spark, range(10), 1).unionByName(archive_rows(spark, [3, 9], 1, "x"))
    new = archive_rows(spark, [2, 4, 8], 2)
    write_archive(old, path)
    want = told(replaced(old, new, day(2), day(5)).select(*old.columns))
    assert [w[2] for w in want if w[3] == 2] == [day(2), day(4)]
    for _ in range(2):
        replace_range(spark, path, new, day(2), day(5))
        assert told(read_archive(spark, path).select(*old.columns)) == want
    part = read_archive(spark, path, day(4), day(9))
    assert {r.start_date for r in part.collect()} == {day(4), day(6), day(7), day(8), day(9)}


def test_reload_keeps_rows_without_a_dataset(spark):
    path = scratch_dir(spark, "t")
    old = archive_rows(spark, range(4), 1).unionByName(archive_rows(spark, range(4), 1, ""))
    write_archive(old, path)
    new = archive_rows(spark, [1], 2, None).unionByName(archive_rows(spark, [2], 2, ""))
    new = new.unionByName(archive_rows(spark, [1, 3], 3))
    for _ in range(2):
        replace_range(spark, path, new, day(1), day(3))
        rows = read_archive(spark, path).collect()
        assert sorted((r.dataset or "", r.start_date, int(r.price)) for r in rows) == [
            ("", day(0), 1), ("", day(1), 2), ("", day(2), 2), ("a b/c", day(0), 1), ("a b/c", day(1), 3), ("a b/c", day(3), 3),
        ]


def test_reload_evaluates_the_new_rows_once(spark):
    """Rows that differ from run to run are written and kept all the same."""
    path = scratch_dir(spark, "t")
    write_archive(archive_rows(spark, range(3), 1), path)
    random = archive_rows(spark, [1], 2).withColumn("dataset", F.concat(F.lit("d"), F.floor(F.rand() * 10**9).cast("string")))
    replace_range(spark, path, random, day(0), day(2))
    assert [int(r.price) for r in read_archive(spark, path).collect()] == [2]


def test_rows_without_a_date_survive_a_reload(spark):
    old = spark.createDataFrame([("n", "a", None, Decimal(1))], ROWS)
    assert replaced(old, archive_rows(spark, [1], 2), day(0), day(3)).count() == 2


def test_reports_as_csv(spark):
    path = scratch_dir(spark, "csv")
    blank = [None] * len(schemas.PRICE_OBS.names)
    rows = []
    for file_id, description in [("f1", 'say "x",\nline'), ("f1", None), ("f2", " padded ")]:
        row = dict(zip(schemas.PRICE_OBS.names, blank), dataset="d", file_id=file_id, description=description)
        rows.append(tuple({**row, "unit": "", "price": Decimal("1.5")}.values()))
    df = spark.createDataFrame(rows, schemas.PRICE_OBS)
    for _ in range(2):
        write_report_csv(df, path)
    write_report_csv(df.withColumn("dataset", F.lit("e")).filter("file_id = 'f2'"), path)
    assert sorted(f for f in os.listdir(f"{path}/dataset=d") if "=" in f) == ["file_id=f1", "file_id=f2"]
    assert sorted(f for f in os.listdir(f"{path}/dataset=e") if "=" in f) == ["file_id=f2"]
    back = read_feed(spark, path, schemas.PRICE_OBS)
    assert sorted((r.dataset, r.file_id, r.description or "none", r.unit) for r in back.collect()) == [
        ("d", "f1", "none", ""), ("d", "f1", 'say "x",\nline', ""), ("d", "f2", " padded ", ""), ("e", "f2", " padded ", ""),
    ]


FEED = "description string, unit string, vendor string, price string, day date"


def clean(feed):
    return feed.select(
        observation_id("description", "vendor", "day").alias("id"),
        F.lit("flowers").alias("dataset"),
        F.col("day").alias("start_date"),
        parse_price(F.col("price")).alias("price"),
    )


def test_incremental_load(spark):
    root, archive = scratch_dir(spark, "feeds"), scratch_dir(spark, "archive")
    checkpoint, seen = scratch_dir(spark, "state"), []
    fields = ["description", "unit", "vendor", "price", "day"]
    feed = lambda n: spark.createDataFrame(
        [(f"rosa {i}", "u", "v", f"RD${i + 1}.50", day(i % 3)) for i in n], FEED
    )
    load = lambda where: load_increment(
        stream_feed(spark, f"{root}/flowers/*", read_schema(FEED)), archive, where, clean,
        also=lambda rows, name: seen.append(rows.count()),
    )
    write_feed(feed(range(6)), root, "flowers", "1", fields)
    load(checkpoint)
    assert read_archive(spark, archive).count() == 6
    # a second run that repeats old rows next to new ones, one of them twice
    write_feed(feed([*range(3, 9), 8]), root, "flowers", "2", fields)
    load(checkpoint)
    assert read_archive(spark, archive).count() == 9
    # everything delivered again to a loader that has lost its state
    load(scratch_dir(spark, "state"))
    rows = read_archive(spark, archive)
    assert rows.count() == 9 and rows.select("id").distinct().count() == 9
    assert seen == [6, 3, 0]


def read_schema(text):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)


def test_rows_with_missing_and_odd_parts_all_arrive(spark):
    root, archive = scratch_dir(spark, "feeds"), scratch_dir(spark, "archive")
    rows = [("a", None, "b", "1.00", DAY), ("a", "b", None, "2.00", DAY), ("a|b", None, None, "3.00", DAY), ("a", "b", "", "4.00", DAY)]
    write_feed(spark.createDataFrame(rows, FEED), root, "flowers", "1", read_schema(FEED).names)
    all_parts = lambda feed: feed.select(
        observation_id("description", "unit", "vendor").alias("id"), F.lit("flowers").alias("dataset"),
        F.col("day").alias("start_date"), parse_price(F.col("price")).alias("price"),
    )
    for _ in range(2):
        load_increment(stream_feed(spark, f"{root}/flowers/*", read_schema(FEED)), archive, scratch_dir(spark, "state"), all_parts)
    assert sorted(int(r.price) for r in read_archive(spark, archive).collect()) == [1, 2, 3, 4]


def test_second_sink_sees_a_failed_batch_again_under_its_name(spark, monkeypatch):
    """The archive fails once after the second sink has been written."""
    root, archive, second, state = (scratch_dir(spark, n) for n in ("feeds", "archive", "second", "state"))
    schema = read_schema(FEED)
    rows = [(f"rosa {i}", "u", "v", "RD$1.50", day(i)) for i in range(5)]
    write_feed(spark.createDataFrame(rows, FEED), root, "flowers", "1", schema.names)
    failures = [True]

    def write(df, path):
        if failures:
            failures.pop()
            raise OSError("archive is away")
        write_archive(df, path)

    monkeypatch.setattr(load, "write_archive", write)
    names = []

    def also(fresh, name):
        names.append(name)
        load.replace_batch(fresh, second, name)

    run = lambda: load_increment(stream_feed(spark, f"{root}/flowers/*", schema), archive, state, clean, also)
    with pytest.raises(Exception, match="archive is away"):
        run()
    run()
    assert len(names) == 2 and len(set(names)) == 1
    assert read_archive(spark, archive).count() == 5
    assert spark.read.parquet(second).count() == 5


def stream_of(spark, batches, schema):
    """A stream that has these rows in one batch each."""
    root = scratch_dir(spark, "in")
    for i, rows in enumerate(batches):
        path = f"{root}/{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_600_000_000 + i, 1_600_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")


def test_stream_drops_repeats_and_keeps_late_rows_apart(spark):
    out, late, state = (scratch_dir(spark, n) for n in ("out", "late", "st"))
    schema = "k string, n int, ts timestamp"
    at = lambda hours: datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=hours)
    batches = [
        [("a", 1, at(0)), ("a", 1, at(0)), ("b", 2, at(30))],
        [("a", 3, at(7)), ("a", 4, at(5)), ("c", 5, at(29)), ("b", 6, at(31)), (None, 7, at(60))],
        [("d", 8, at(35)), (None, 9, at(59)), ("b", 10, at(61)), ("e", 11, None)],
    ]
    feed = stream_of(spark, batches, schema)
    stream_without_repeats(feed, ["k"], "1 day", out, late, state)
    read = lambda path: sorted(r.n for r in spark.read.schema(schema).parquet(path).collect())
    # a at 7 is the same key within a day, at 5 it is late; b is remembered from 30 until newest is past 78
    assert read(out) == [1, 2, 5, 7, 11]
    assert read(late) == [4, 8]


def test_a_stream_forgets_what_time_has_passed(spark):
    """Ever new keys, one and the same key, and a column called batch: state and work stay as small as two days."""
    out, late, state = (scratch_dir(spark, n) for n in ("out", "late", "st"))
    at = lambda hours: datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=hours)
    batches = [[(f"{i}-{j}", i, at(24 * i + j)) for j in range(10)] + [("same", i, at(24 * i))] * 3 for i in range(9)]
    query = stream_without_repeats(stream_of(spark, batches, "k string, batch int, ts timestamp"), ["k"], "1 day", out, late, state)
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    read = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert read == [13] * 9
    assert held[-1] <= 40 and max(held[4:]) <= max(held[:4]) + 13
    rows = spark.read.option("recursiveFileLookup", True).schema("k string, ts timestamp").parquet(out).collect()
    assert len({r.k for r in rows}) == len([r for r in rows if r.k != "same"]) + 1 == 91
    # kept at day 0; the mark must be past a day after it before the key is new again
    assert sorted(r.ts.day for r in rows if r.k == "same") == [1, 4, 7]
    assert spark.read.option("recursiveFileLookup", True).schema("k string").parquet(late).count() == 0


def test_a_stream_keeps_its_state_by_group(spark):
    """One entry in the store, and one call, holds many keys."""
    out, late, state = (scratch_dir(spark, n) for n in ("out", "late", "st"))
    at = lambda minutes: datetime.datetime(2020, 1, 1) + datetime.timedelta(minutes=minutes)
    batches = [[(i, 0, at(i % 60)) for i in range(9000)], [(i, 1, at(60 + i % 60)) for i in range(8900, 9100)]]
    query = stream_without_repeats(stream_of(spark, batches, "k long, n int, ts timestamp"), ["k"], "1 day", out, late, state)
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) <= 4096
    rows = spark.read.schema("k long, n int").parquet(out).collect()
    assert sorted(r.k for r in rows) == [*range(9100)] and {r.k for r in rows if r.n} == {*range(9000, 9100)}


def test_keys_of_one_group_are_told_apart_and_forgotten_each_in_its_time(spark):
    out, late, state = (scratch_dir(spark, n) for n in ("out", "late", "st"))
    start, random = datetime.datetime(2020, 1, 1), Random(3)
    time = lambda day: None if random.random() < 0.1 else start + datetime.timedelta(hours=24 * day + random.randrange(60), microseconds=random.randrange(9))
    batches = [[(random.choice(["a", "b", "", None]), random.choice([1, 2, None]), 100 * i + j, time(i)) for j in range(30)] for i in range(4)]
    feed = stream_of(spark, batches, "k string, l int, n int, ts timestamp")
    stream_without_repeats(feed, ["k", "l"], "1 day", out, late, state, groups=2)

    # the rule in plain words: of each batch the late rows, then the earliest of each key that is not remembered
    day, want, want_late, held, newest = datetime.timedelta(1), [], [], {}, start
    for rows in batches:
        mark, first = newest - day, {}
        mark -= datetime.timedelta(microseconds=mark.microsecond % 1000)
        for k, l, n, at in sorted(rows, key=lambda r: (r[3] is None, r[3] or start)):  # noqa: E741
            if at and at < mark:
                want_late.append(n)
            else:
                first.setdefault((k, l), (n, at))
        for key, (n, at) in first.items():
            if key not in held or held[key] + day < mark:
                want.append((key, at))
                held |= {key: at} if at else {}
        newest = max([newest, *(r[3] for r in rows if r[3])])
    key_and_time = lambda r: ((r.k, r.l), r.ts)
    read = spark.read.schema("k string, l int, n int, ts timestamp").parquet
    assert sorted(map(key_and_time, read(out).collect()), key=repr) == sorted(want, key=repr)
    assert sorted(r.n for r in read(late).collect()) == sorted(want_late)
    assert want_late and len(want) > len(held)


def test_texts_of_keys_are_equal_where_keys_are(spark):
    second = datetime.datetime(2020, 10, 25, 1, 30)
    values = [
        (0.0, "a", b"\xff", second, [1.5, None], Decimal("1.0")), (-0.0, "a", b"\xff", second, [1.5, None], Decimal("1.00")),
        (float("nan"), 'a","k1":"b', b"\xfe", second + datetime.timedelta(microseconds=1), [], Decimal("1.01")),
        (float("nan"), "None", b"", second + datetime.timedelta(hours=1), [None], None), (None, None, None, None, None, None), (None, "", b"\x00", second, [1.5], None),
    ]
    rows = spark.createDataFrame(values, "x double, s string, b binary, t timestamp, l array<double>, d decimal(9,2)")
    rows = rows.withColumn("n", F.col("t").cast("timestamp_ntz")).withColumn("day", F.col("t").cast("date")).withColumn("both", F.struct("s", "t"))
    rows = rows.select("*", *(key_text(rows, [c]).alias(f"{c}_text") for c in rows.columns), key_text(rows, rows.columns).alias("text"))
    names = [c for c in rows.columns if f"{c}_text" in rows.columns]
    same = [F.col(f"left.{c}").eqNullSafe(F.col(f"right.{c}")) for c in names]
    same_text = [F.col(f"left.{c}").eqNullSafe(F.col(f"right.{c}")) for c in [*(f"{c}_text" for c in names), "text"]]
    both = rows.alias("left").crossJoin(rows.alias("right"))
    for pair in both.select(F.array(*same, reduce(and_, same)).alias("same"), F.array(*same_text).alias("same_text")).collect():
        assert pair.same == pair.same_text


def test_a_stream_goes_on_after_a_failed_batch(spark, monkeypatch):
    """The second folder cannot be written once: the batch comes again and nothing is there twice."""
    from pricegrid.streaming import repeats

    out, late, state = (scratch_dir(spark, n) for n in ("out", "late", "st"))
    at = lambda hours: datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=hours)
    batches = [[("a", 1, at(0)), ("b", 2, at(50))], [("a", 3, at(1)), ("b", 4, at(51)), ("c", 5, at(52))], [("c", 6, at(53))]]
    feed, write, calls = stream_of(spark, batches, "k string, n int, ts timestamp"), repeats.replace_batch, []

    def failing(rows, path, name):
        calls.append(name)
        if len(calls) == 4:
            raise OSError("disk is away")
        write(rows, path, name)

    monkeypatch.setattr(repeats, "replace_batch", failing)
    with pytest.raises(Exception, match="disk is away"):
        stream_without_repeats(feed, ["k"], "1 day", out, late, state)
    stream_without_repeats(feed, ["k"], "1 day", out, late, state)
    read = lambda path: sorted(r.n for r in spark.read.schema("n int").parquet(path).collect())
    assert read(out) == [1, 2, 5] and read(late) == [3]


def test_nothing_is_lost_in_a_stream_out_of_order(spark, sf_dir):
    out, late, state, files = (scratch_dir(spark, n) for n in ("out", "late", "st", "ev"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("user_id", "event_type", "cast(ts as timestamp) ts", "cast(ts as date) day")
    events.repartition(4, F.hash("ts")).write.parquet(files)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
    key = ["user_id", "event_type", "day"]
    stream_without_repeats(feed, key, "1 day", out, late, state)
    both = [spark.read.schema(events.schema).parquet(p).select(*key) for p in (out, late)]
    assert both[0].count() == both[0].distinct().count()
    assert both[1].count() > 0
    assert both[0].union(both[1]).distinct().count() == events.select(*key).distinct().count()


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root + "/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_database_address():
    assert database.postgres_url("h", 5432, "precios") == "jdbc:postgresql://h:5432/precios"


def test_feed_refuses_to_overwrite_a_run(spark):
    df = spark.createDataFrame([("a",)], "description string")
    root = scratch_dir(spark, "feeds")
    write_feed(df, root, "flowers", "1", ["description"])
    with pytest.raises(Exception, match="(?i)exists"):
        write_feed(df, root, "flowers", "1", ["description"])


@pytest.mark.parametrize("name", ["report_csv_export", "medicine_csv_export"])
def test_exports_work_observations_out_once(spark, sf_dir, monkeypatch, name):
    written = []
    monkeypatch.setattr(queries, "write_report_csv", lambda df, *rest: written.append(df) or write_report_csv(df, *rest))
    assert queries.QUERIES[name](spark, sf_dir).count()
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in written]
    assert len(plans) == 2 and not any("Join" in plan or "Window" in plan for plan in plans)
