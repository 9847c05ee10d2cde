"""The stream of reading messages, one raw payload per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# What bounds a micro-batch, by the name each kind of source has for it.
ADMISSION = {
    "text": {"files": "maxFilesPerTrigger", "size": "maxBytesPerTrigger"},
    "kafka": {"records": "maxOffsetsPerTrigger"},
}


def admission(source: str, **limits: int | str | None) -> dict[str, str]:
    """Reader options that bound a micro-batch: `files` or `size` of text files, `records` of a broker."""
    known = ADMISSION.get(source, {})
    unknown = sorted(name for name, limit in limits.items() if limit is not None and name not in known)
    if unknown:
        raise ValueError(f"a {source} stream has no limit on {', '.join(unknown)}")
    return {known[name]: str(limit) for name, limit in limits.items() if limit is not None}


def read_reading_stream(
    spark: SparkSession, path: str | None = None, source: str = "text", **options: str,
) -> DataFrame:
    """Payloads as text, at least once.

    Without a limit a first micro-batch takes all that waits, after an outage as well. Pass `**admission(...)`
    to bound it: what is left waits for the next ones.

    The payload is not parsed here, so that a malformed one can still be landed and
    reported. For a message broker pass its format, such as `source="kafka"`, and its
    options; the payload is then the record's `value`.
    """
    reader = spark.readStream.format(source).options(**options)
    rows = reader.load(path) if path else reader.load()
    return rows.select(F.col("value").cast("string").alias("payload"))
