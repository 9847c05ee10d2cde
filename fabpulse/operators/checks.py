"""Row counts and constraint checks, each a small DataFrame."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabpulse.schemas import TABLES, Table


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def table_row_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per table; NULL for a table that is absent."""
    counts = [
        (
            spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
            if df is None else row_count(df)
        ).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def constraint_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule of the tables given, with the number of violations.

    Duplicate keys count once per key, missing and dangling values once per row.
    Foreign keys are checked where the referenced table is given too.
    """
    results = []
    for name, df in tables.items():
        table = TABLES[name]
        results += [_duplicates(table, df, column) for column in (table.key, *table.unique)]
        results.append(_row_rules(table, df, tables))
    return reduce(DataFrame.unionByName, results)


def _duplicates(table: Table, df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("violations"))
        .select(
            F.lit(table.name).alias("table_name"), F.lit(f"unique {column}").alias("rule"),
            "violations",
        )
    )


def _row_rules(table: Table, df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """NOT NULL and foreign-key rules, counted together in one pass over the table."""
    rules: dict[str, Column] = {
        f"not null {column}": F.col(column).isNull() for column in (table.key, *table.unique)
    }
    checked = df
    for column, (other, key) in table.references.items():
        if other in tables:
            present = tables[other].select(F.col(key).alias(column)).distinct()
            found = f"_found_{column}"
            checked = checked.join(present.withColumn(found, F.lit(True)), column, "left")
            rules[f"{column} in {other}"] = F.col(column).isNotNull() & F.col(found).isNull()
    counted = checked.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    rows = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("violations"))
        for rule in rules
    ])
    return counted.select(F.lit(table.name).alias("table_name"), F.inline(rows))
