"""Which keys a table holds, by a hash of the key.

A Parquet table has no index, so an insert-or-ignore would read the key column of the whole table for every load
and every micro-batch. Beside such a table lies an index of its keys, partitioned by a hash of the key:
a batch reads only the partitions its own keys fall in. With few keys these are few, and a batch
with keys in all of them reads all keys, as it must.

The table is the only truth. The index names the files of the table it covers; files written since are
read by themselves, and taken into the index once they are many. So a load that fails at any point leaves
nothing to repair: what it wrote to the table is seen by the next load, in the index or not. If a
covered file is gone, the table was rewritten, and the index is made anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabpulse.layout import Layout
from fabpulse.schemas import KEY_BUCKET, TABLES
from fabpulse.session import file_system
from fabpulse.sources.literal import literal_rows
from fabpulse.sources.tables import table_or_none

KEY_BUCKETS = 256
FRESH_FILES = 64  # files beside the index, at most


def key_bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def held_keys(spark: SparkSession, layout: Layout, name: str, rows: DataFrame) -> DataFrame:
    """The keys of a table that `rows` may meet: those of the same partitions of the index, and fresh ones.

    `rows` is read for the partitions of its keys, of which there are at most 256.
    """
    key = TABLES[name].key
    index, fresh = open_index(spark, layout, name)
    found = []
    if index is not None:
        buckets = [r[0] for r in rows.select(key_bucket(F.col(key))).distinct().collect()]
        found.append(index.filter(F.col(KEY_BUCKET).isin(buckets)).select(key))
    if fresh:
        found.append(_keys_of(spark, name, fresh))
    if not found:
        return literal_rows(spark, [], _key_schema(name))
    first, *rest = found
    return first.unionByName(rest[0]) if rest else first


def open_index(
    spark: SparkSession, layout: Layout, name: str, fresh_files: int = FRESH_FILES,
) -> tuple[DataFrame | None, list[str]]:
    """The index of a table and the files it does not cover yet, after it took in those that are too many."""
    table = table_or_none(spark, layout, name)
    files = set() if table is None else set(table.inputFiles())
    covered = _covered(spark, layout, name)
    if covered - files:
        _forget(spark, layout, name)
        covered = set()
    fresh = sorted(files - covered)
    if len(fresh) > fresh_files:
        _take_in(spark, layout, name, fresh)
        covered, fresh = files, []
    if not covered:
        return None, fresh
    schema = T.StructType([*_key_schema(name).fields, T.StructField(KEY_BUCKET, T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{layout.keys(name)}/keys"), fresh


def _key_schema(name: str) -> T.StructType:
    table = TABLES[name]
    return T.StructType([table.schema[table.key]])


def _keys_of(spark: SparkSession, name: str, files: list[str]) -> DataFrame:
    return spark.read.schema(_key_schema(name)).parquet(*files)


def _covered(spark: SparkSession, layout: Layout, name: str) -> set[str]:
    """The files the index covers: as many names as Spark's own listing of the table holds."""
    path, files = file_system(spark, f"{layout.keys(name)}/covered")
    if not files.exists(path):
        return set()
    return {row[0] for row in spark.read.schema("file STRING").json(str(path)).collect()}


def _take_in(spark: SparkSession, layout: Layout, name: str, files: list[str]) -> None:
    """Add the keys of files, then say so. Keys added twice, after a failure in between, do no harm."""
    keys = _keys_of(spark, name, files)
    bucketed = keys.withColumn(KEY_BUCKET, key_bucket(F.col(TABLES[name].key)))
    bucketed.hint("rebalance", KEY_BUCKET).write.mode("append").partitionBy(KEY_BUCKET) \
        .parquet(f"{layout.keys(name)}/keys")
    names = literal_rows(spark, [(f,) for f in files], T.StructType([T.StructField("file", T.StringType())]))
    # A folder of its own, that appears under its name when it is whole.
    folder = f"{layout.keys(name)}/covered"
    staged, store = file_system(spark, f"{layout.keys(name)}/_{uuid.uuid4().hex}")
    names.coalesce(1).write.json(str(staged))
    target, _ = file_system(spark, folder)
    store.mkdirs(target)
    for status in store.listStatus(staged):
        if status.getPath().getName().endswith(".json"):
            store.rename(status.getPath(), file_system(spark, f"{folder}/{uuid.uuid4().hex}.json")[0])
    store.delete(staged, True)


def _forget(spark: SparkSession, layout: Layout, name: str) -> None:
    """Remove the index, the list of what it covers first."""
    for part in ("covered", "keys"):
        path, files = file_system(spark, f"{layout.keys(name)}/{part}")
        files.delete(path, True)
