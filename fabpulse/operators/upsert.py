"""Insert-or-ignore and insert-or-replace as joins on the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabpulse.operators.dedup import first_per_key


def with_required_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the query on a NULL key, as a NOT NULL constraint would."""
    checked = {
        key: F.coalesce(
            F.col(key),
            F.raise_error(f"NULL in key column {key}").cast(df.schema[key].dataType),
        )
        for key in keys
    }
    return df.withColumns(checked)


def rows_to_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
) -> DataFrame:
    """First source row of every key the target does not hold.

    Only the key columns of the target are read, and only those of them that the source holds
    as well take part in the second join. While the source is small its keys are broadcast, so
    the target is not shuffled.
    """
    first = first_per_key(with_required_keys(source, keys), keys, order_by)
    held = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    return first.join(held, list(keys), "left_anti").select(*source.columns)


def insert_or_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
) -> DataFrame:
    """The target after the insert: existing rows win."""
    return target.unionByName(rows_to_insert(target, source, keys, order_by))


def insert_or_replace(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
) -> DataFrame:
    """The target after the upsert: source rows win, the other rows stay.

    Among source rows of one key the first in `order_by` wins.
    """
    new = first_per_key(with_required_keys(source, keys), keys, order_by)
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(new)
