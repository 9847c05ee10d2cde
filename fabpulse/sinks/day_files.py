"""Which files each day of the fact table was read from, kept beside what is derived from it.

A load adds files to a day, a replacement exchanges them, both under new names. So a derived table that stores a
digest of each day's file names knows the days it has to compute again, without reading any fact.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterable
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabpulse.schemas import PARTITION_DAY
from fabpulse.session import file_system
from fabpulse.sources.literal import literal_rows

NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # how a partition without a value is named
_NAMES = T.StructType([T.StructField("day", T.StringType()), T.StructField("files", T.StringType())])


def files_by_day(fact: DataFrame) -> dict[str, str]:
    """For each partition a digest of its files' names, from Spark's own listing of the table."""
    days = defaultdict(list)
    for uri in fact.inputFiles():
        folder, _, file = uri.rpartition("/")
        days[unquote(folder.rpartition(f"{PARTITION_DAY}=")[2])].append(file)
    return {day: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for day, files in days.items()}


def in_days(days: Iterable[str]) -> Column:
    """Rows of days, given as their partitions are named."""
    day = F.col(PARTITION_DAY)
    dated = day.isin([date.fromisoformat(d) for d in days if d != NO_DAY])
    return dated | day.isNull() if NO_DAY in days else dated


def stored_names(spark: SparkSession, root: str) -> dict[str, str]:
    """One entry per day of the calendar. Of files left by a run that failed in between, the latest counts."""
    path, files = file_system(spark, f"{root}/names")
    if not files.exists(path):
        return {}
    latest = max(status.getPath().getName() for status in files.listStatus(path))
    rows = spark.read.schema(_NAMES).json(f"{path.toString()}/{latest}").collect()
    return {row["day"]: row["files"] for row in rows}


def store_names(spark: SparkSession, root: str, names: dict[str, str]) -> None:
    """Publish a folder of names by one rename, under the next number, and remove those before it."""
    folder, files = file_system(spark, f"{root}/names")
    files.mkdirs(folder)
    old = sorted(status.getPath().getName() for status in files.listStatus(folder))
    number = int(old[-1].removeprefix("n")) + 1 if old else 0
    staged, _ = file_system(spark, f"{root}/_{uuid.uuid4().hex}")
    literal_rows(spark, sorted(names.items()), _NAMES).coalesce(1).write.json(staged.toString())
    files.rename(staged, file_system(spark, f"{folder.toString()}/n{number:012}")[0])
    for name in old:
        files.delete(file_system(spark, f"{folder.toString()}/{name}")[0], True)
