"""Archives in snapshots: a reader sees a load whole or not at all.

A load writes its rows to a folder of its own and a manifest of all folders
that count from then on. Only then one small file, the next snapshot, is put in
its place by a rename, which fails if another load has taken that number;
then the manifest is made anew on top of the other one. Readers take the
newest snapshot and read the folders it names. Whatever fails in between
leaves files that nothing refers to, and ``expire`` removes them.

    path/rows/load=<id>/dataset=<name>/start_date=<day>/...
    path/manifests/<id>/...         folder, start_date
    path/snapshots/<number>.json    the manifest's name and the rows' schema

A manifest has a row for each load, dataset and day that counts: many reloads
add nothing to it, as reloaded days leave it.
"""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pricegrid.sinks.files import by_folder

MANIFEST = "folder string, start_date date"
DAY = "start_date"


@dataclass(frozen=True)
class Snapshot:
    number: int
    manifest: str
    schema: T.StructType


def _files(spark: SparkSession, path: str):
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    return new_path, new_path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    new_path, files = _files(spark, path)
    found = files.globStatus(new_path(f"{path}/snapshots/*.json")) or []
    return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found)


def snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot | None:
    """The newest snapshot, or an earlier one by its number; none, if nothing has been loaded."""
    if number is None:
        number = max(_numbers(spark, path), default=None)
        if number is None:
            return None
    text = "".join(row[0] for row in spark.read.option("wholetext", True).text(f"{path}/snapshots/{number:010d}.json").collect())
    told = json.loads(text)
    return Snapshot(number, told["manifest"], T.StructType.fromJson(told["schema"]))


def _manifest(spark: SparkSession, path: str, at: Snapshot | None) -> DataFrame:
    if at is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifests/{at.manifest}")


def read_snapshot(
    spark: SparkSession, path: str, first: datetime.date | None = None, last: datetime.date | None = None, number: int | None = None
) -> DataFrame:
    """Rows of a snapshot. Only folders that it names, and of a date range only those of its days, are looked at."""
    at = snapshot(spark, path, number)
    if at is None:
        raise FileNotFoundError(f"nothing has been loaded to {path}")
    named = _manifest(spark, path, at)
    if first:
        named = named.filter(F.col(DAY) >= F.lit(first))
    if last:
        named = named.filter(F.col(DAY) <= F.lit(last))
    # a folder for each load, dataset and day
    folders = [f"{path}/rows/{row.folder}" for row in named.select("folder").distinct().toLocalIterator()]
    if not folders:
        return spark.createDataFrame([], at.schema)
    return spark.read.schema(at.schema).option("basePath", f"{path}/rows").parquet(*folders).select(*at.schema.names)


def _write_rows(rows: DataFrame, path: str, load: str) -> DataFrame:
    """Write a load's rows; the folders that hold any, with their day."""
    spark, target = rows.sparkSession, f"{path}/rows/load={load}"
    keys = [c for c in ("dataset", DAY) if c in rows.columns]
    by_folder(rows, *keys).write.partitionBy(*keys).parquet(target)
    _, files = _files(spark, path)
    if not files.globStatus(_files(spark, path)[0](f"{target}/*=*")):
        return spark.createDataFrame([], MANIFEST)
    written = spark.read.schema(rows.schema).parquet(target)
    folder = F.regexp_extract(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), r"/(load=[^/]*/.*)/[^/]*\z", 1)
    return written.select(F.col("_metadata.file_path").alias("file"), DAY).select(folder.alias("folder"), DAY).distinct()


def _publish(spark: SparkSession, path: str, at: Snapshot) -> bool:
    """Put a snapshot in its place; false if there is one of that number already."""
    new_path, files = _files(spark, path)
    jvm = spark._jvm
    target, draft = f"{path}/snapshots/{at.number:010d}.json", new_path(f"{path}/snapshots/{uuid.uuid4().hex}.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps({"manifest": at.manifest, "schema": at.schema.jsonValue()}).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(new_path(target)), options)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def _load(spark: SparkSession, path: str, new: DataFrame, gone) -> Snapshot:
    """Add a load's rows to those that ``gone`` leaves of the manifest."""
    fresh = _write_rows(new, path, uuid.uuid4().hex).persist()
    try:
        while True:
            before = snapshot(spark, path)
            kept = _manifest(spark, path, before)
            if gone is not None:
                kept = kept.filter(~F.coalesce(gone, F.lit(False)))
            after = Snapshot(0 if before is None else before.number + 1, uuid.uuid4().hex, new.schema)
            # folders, not rows: one file is enough
            kept.unionByName(fresh).coalesce(1).write.parquet(f"{path}/manifests/{after.manifest}")
            if _publish(spark, path, after):
                return after
    finally:
        fresh.unpersist()


def append_rows(spark: SparkSession, path: str, new: DataFrame) -> Snapshot:
    """Add rows; what is there stays."""
    return _load(spark, path, new, None)


def reload_range(spark: SparkSession, path: str, new: DataFrame, first: datetime.date, last: datetime.date) -> Snapshot:
    """Replace a range of days by the new rows of these days, for all readers at once.

    Days that the new load has no rows for are empty afterwards; rows without a
    date stay. Doing it twice, or again after a failure, gives the same rows.
    """
    inside = F.col(DAY).between(F.lit(first), F.lit(last))
    return _load(spark, path, new.filter(inside), inside)


def expire(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete what the newest ``keep`` snapshots do not refer to. For when no load is on its way."""
    numbers = _numbers(spark, path)
    old, kept = numbers[:-keep], [snapshot(spark, path, n) for n in numbers[-keep:]]
    new_path, files = _files(spark, path)
    named = {s.manifest for s in kept}
    loads: set[str] = set()
    for at in kept:
        rows = _manifest(spark, path, at).select(F.substring_index("folder", "/", 1).alias("load")).distinct()
        loads |= {row.load for row in rows.toLocalIterator()}
    for number in old:
        files.delete(new_path(f"{path}/snapshots/{number:010d}.json"), False)
    for folder, wanted in (("manifests", named), ("rows", loads)):
        for status in files.globStatus(new_path(f"{path}/{folder}/*")) or []:
            if status.getPath().getName() not in wanted:
                files.delete(status.getPath(), True)
    for status in files.globStatus(new_path(f"{path}/snapshots/*.draft")) or []:
        files.delete(status.getPath(), False)
