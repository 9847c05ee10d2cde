"""Small fixed tables as local relations, whose size the planner knows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ARROW_TYPES = {
    T.IntegerType(): pa.int32(),
    T.StringType(): pa.string(),
    T.LongType(): pa.int64(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.DateType(): pa.date32(),
    T.TimestampType(): pa.timestamp("us", "UTC"),
}


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A DataFrame of a few rows given in the code.

    Passed as Arrow it becomes a local relation. As a list it would be an RDD of unknown
    size, and a join with it would shuffle the large side.
    """
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    table = pa.table({
        field.name: pa.array(values, ARROW_TYPES[field.dataType])
        for field, values in zip(schema.fields, columns, strict=True)
    })
    return spark.createDataFrame(table, schema)
