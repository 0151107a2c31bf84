"""Repeats in a stream, by keyed state that is dropped when event time has passed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, FloatType, MapType, StructType, TimestampType

from pricegrid.streaming.load import replace_batch

# Fixed value: the store that state with timers needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Fixed value: keys are dealt to so many groups, each with one entry in the store.
GROUPS = 4096


class FirstOfKey(StatefulProcessor):
    """For a group of keys the time of each one's kept row, until the watermark is ``delay`` past it.

    A group asks for its state once and writes it once a batch, since each call
    costs far more than a key. Rows of a batch are looked at one after the other
    and none but the earliest on time of each key is kept in memory. Late rows
    are handed on, marked.
    """

    def __init__(self, delay: int, columns: list[str]):
        self.delay = delay
        self.row = Row(*columns)

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "keys array<string>, times array<bigint>")

    def keep(self, held: dict[str, int]) -> None:
        """Write what is held, with a timer for the first that is to go."""
        if held:
            self.kept.update((list(held), list(held.values())))
            self.handle.registerTimer((min(held.values()) + self.delay) // 1000 + 1)
        else:
            self.kept.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000  # newest time of earlier batches, less the delay
        first = {}
        for row in rows:
            *values, _, name, at = row
            if at is not None and at < mark:
                yield self.row(*values, True)
            elif name not in first or (at is not None and (first[name][-1] is None or at < first[name][-1])):
                first[name] = row
        if not first:
            return
        held = dict(zip(*(self.kept.get() or ((), ()))))
        held = {name: at for name, at in held.items() if at + self.delay >= mark}
        fresh = [row for name, row in first.items() if name not in held]
        new = {name: at for *_, name, at in fresh if at is not None}
        if new:
            self.keep(held | new)
        for *values, _, _, _ in fresh:
            yield self.row(*values, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = dict(zip(*(self.kept.get() or ((), ()))))
        left = {name: at for name, at in held.items() if at + self.delay >= mark}
        if len(left) < len(held):
            self.keep(left)
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession):
    """Queries that start here keep their state in a store with timers."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def key_text(feed: DataFrame, key: list[str]) -> Column:
    """A text that is the same for equal keys only; missing parts are equal to each other."""
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    parts = []
    for i, part in enumerate(feed.select(*key).schema):
        value, kind = F.col(key[i]), part.dataType
        if isinstance(kind, (FloatType, DoubleType)):
            value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)  # zeros of either sign are equal
        elif isinstance(kind, TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, BinaryType):
            value = F.hex(value)
        nested = isinstance(kind, (ArrayType, MapType, StructType))
        parts.append((value if nested else value.cast("string")).alias(f"k{i}"))
    return F.to_json(F.struct(*parts), options)


def marked_repeats(feed: DataFrame, key: list[str], delay: str, ts: str, flag: str, groups: int = GROUPS) -> DataFrame:
    """The first row of each key within ``delay``, and all late rows; ``flag`` says which. Call it in ``state_store``."""
    spark = feed.sparkSession
    width = spark.sql(f"select unix_micros(timestamp'1970-01-01 00:00:00 UTC' + interval {delay})").first()[0]
    names = [f"`{c}`" for c in feed.columns]
    # the watermark hangs on a copy of the time, which then goes: so Spark keeps it up and late rows are not dropped
    timed = feed.withColumn(f"{flag}_mark", F.col(ts).cast("timestamp")).withWatermark(f"{flag}_mark", delay)
    timed = timed.select(*names, key_text(feed, key).alias(f"{flag}_key"), F.unix_micros(F.col(ts).cast("timestamp")).alias(f"{flag}_at"))
    timed = timed.select(*names, F.pmod(F.xxhash64(f"{flag}_key"), F.lit(groups)).alias(f"{flag}_group"), f"{flag}_key", f"{flag}_at")
    out = StructType(list(feed.schema)).add(flag, BooleanType())
    return timed.groupBy(f"{flag}_group").transformWithState(
        statefulProcessor=FirstOfKey(width, out.names), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )


def stream_without_repeats(
    feed: DataFrame,
    key: list[str],
    delay: str,
    out: str,
    late: str,
    checkpoint: str,
    ts: str = "ts",
    groups: int = GROUPS,
):
    """The first row of each key within ``delay``, and apart what came too late.

    A row is late if its time lies more than ``delay`` before the newest time of
    the batches before its own. A key is remembered as long as a row that is not
    late can lie within ``delay`` of it; meanwhile one of its rows goes to
    ``out``, of those in one batch the earliest. Late rows may repeat a key that
    is no longer remembered; they all go to ``late``, so that no row is lost
    unsaid. Rows without a time are never late and not remembered. Where every
    repeat counts, as in daily loads, ``load_increment`` asks the whole archive
    instead.

    Keys and times are all the state there is; a timer drops them. Keys are dealt
    to ``groups`` by a hash, and a batch reads and writes the state of each group
    it has rows of as one entry: more groups make entries smaller and calls more.
    A checkpoint goes on with the number it began with. A batch reads
    its own rows and nothing that earlier ones have written. It has folders of
    its own, which a second try replaces. Times count in milliseconds where the
    watermark is concerned. Returns the finished query.
    """
    flag = "__late"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            for is_late, path in ((True, late), (False, out)):
                replace_batch(rows.filter(F.col(flag) == is_late).drop(flag), path, str(batch_id))
        finally:
            rows.unpersist()

    with state_store(feed.sparkSession):
        query = (
            marked_repeats(feed, key, delay, ts, flag, groups)
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{checkpoint}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return query
