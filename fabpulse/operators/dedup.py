"""First row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in `order_by`, which must order a key's rows totally.

    Spark limits each key to one row per map task before the shuffle
    (WindowGroupLimit), so a key repeated billions of times does not pile up.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
