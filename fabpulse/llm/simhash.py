"""Near duplicates by SimHash fingerprints that differ in few bits.

A fingerprint has 64 bits: one is set if it is set in over half of the hashes of a text's word
shingles. Fingerprints link at two or fewer differing bits. To find the links, the fingerprint is
cut into two segments of 32 bits, so that of two linked ones a segment differs by one bit at
most. Each distinct fingerprint is indexed under its segments and under their deletion variants,
in which one bit is a wildcard. Entries join on equality of key, those of a wildcard with the other
value of the bit only, and the whole fingerprints are compared. Copies share a fingerprint, so
they cost no pairs.

A key may hold so many fingerprints that its pairs would be too many. Their links are found
exactly in another way: two fingerprints differ in at most two bits if and only if they share a
value one bit away, so all such neighbours are indexed, and those that meet are a group of 65 at
most, all linked. `CROWD` decides where this takes over, and changes no result.

Defined results: a null text, or one without words, has fingerprint zero, linked like any other.
A text with fewer words than a shingle is one shingle. Documents with a null id take part; a
component with no other documents has a null component_id. Repeated rows come back repeated.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from fabpulse.llm.components import components
from fabpulse.llm.scratch import stored

BITS, SEGMENT, MAX_DISTANCE = 64, 32, 2
SEED = 42
CROWD = 64
_SLICE = 1 << 15  # shingles at a time


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of a whole text, as an unsigned number."""
    words = (text or "").encode().lower().split()  # lower() of bytes touches A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = list(accumulate(map(len, words), lambda at, size: at + 1 + size))
    starts = [0, *(end + 1 for end in ends)]
    count = len(words) - shingle + 1
    set_bits = np.zeros(BITS, np.int64)
    for low in range(0, count, _SLICE):
        high = min(count, low + _SLICE)
        hashes = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(
            starts[low:high], ends[low + shingle - 1:high + shingle - 1])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(set_bits * 2 > count, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, shingle: int = 3) -> Column:
    """As a signed long column."""
    @F.arrow_udf("bigint")
    def signed(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
        return pa.array(found.view(np.int64))

    return signed.asNondeterministic()(text)


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _entries(prints: DataFrame) -> DataFrame:
    """(key, bit, fp): the two segments whole, and with each bit in turn left out.

    A key packs segment number, position of the wildcard (32: none) and the other bits.
    """
    per_segment = SEGMENT + 1
    placed = (
        prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * per_segment - 1))).alias("slot"))
        .select("fp", F.expr(f"slot div {per_segment}").alias("part"),
                F.expr(f"cast(slot % {per_segment} as int)").alias("at"))
        .withColumn("segment", F.expr(
            "if(part = 0, shiftrightunsigned(fp, 32), fp & 4294967295L)"))
        .withColumn("hole", F.expr(f"if(at = {SEGMENT}, 0L, shiftleft(1L, at))"))
    )
    return placed.select(
        "fp", F.expr("shiftleft(part * 64 + at, 32) | (segment & ~hole)").alias("key"),
        F.expr("cast((segment & hole) <> 0 as int)").alias("bit"))


def _whole(key: str = "key") -> Column:
    """Whether a key has no wildcard."""
    return F.expr(f"shiftright({key}, 32) % 64 = {SEGMENT}")


def _neighbour_edges(prints: DataFrame) -> DataFrame:
    """Links among the fingerprints, by the values they share that are one bit away."""
    near = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS))).alias("at")).select(
        "fp", F.expr(f"if(at = {BITS}, fp, fp ^ shiftleft(1L, cast(at % {BITS} as int)))").alias("value"))
    # Only 65 fingerprints are one bit away from a value, so the lists are bounded.
    met = (near.groupBy("value").agg(F.collect_list("fp").alias("fps"))
           .where(F.size("fps") > 1))
    return (met.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v"))
            .where("u <> v").distinct())


def fingerprint_links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) that connect all fingerprints at two or fewer differing bits.

    `prints` has distinct values in `fp`. Of a crowded key, the links make a spanning structure,
    not all pairs.
    """
    entries = _entries(prints)
    live = (
        entries.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("bit").alias("low"), F.max("bit").alias("high"))
        .where(F.col("n") > 1).where(_whole() | (F.col("low") < F.col("high")))
        .select("key", "n")
    )
    shared = stored(entries.join(live, "key"), "segments")
    few, many = shared.where(F.col("n") <= crowd), shared.where(F.col("n") > crowd)
    pairs = (
        few.select("key", F.col("fp").alias("u"), F.col("bit").alias("bit_u"))
        .join(few.select("key", F.col("fp").alias("v"), F.col("bit").alias("bit_v")), "key")
        .where((F.col("u") < F.col("v")) & (_whole() | (F.col("bit_u") != F.col("bit_v")))
               & (_distance("u", "v") <= MAX_DISTANCE))
        .select("u", "v")
    )
    return pairs.union(_neighbour_edges(many.select("fp").distinct())).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, crowd: int = CROWD) -> DataFrame:
    """(doc_id, fp, component_id, root) for each row of `docs`; doc_id and text are read.

    component_id is the least doc_id of a component, root its least fingerprint.
    """
    marked = stored(docs.select("doc_id", fingerprint_of(F.col("text"), shingle).alias("fp")),
                    "fingerprints")
    prints = marked.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    links = fingerprint_links(prints.select("fp"), crowd)
    roots = components(links)
    rooted = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    classes = rooted.join(firsts, "root").select("fp", "root", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id", "root")


def fingerprint_text(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of `docs` for each component: of its smallest doc_id, nulls after the others.

    Rows that share a doc_id are told apart by their fingerprints; of equal ones one stays. Every
    text is looked at once more, before rows meet heads by both, so an id of many rows and many
    heads makes no pairs.
    """
    names = docs.columns
    found = near_duplicates(docs, shingle).withColumn("__id", _never_null("doc_id"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "__id", "fp")
    heads = found.groupBy("root").agg(F.min(order).alias("head"))
    keep = heads.select(F.col("head.__id").alias("__id"), F.col("head.fp").alias("__fp"))
    own = fingerprint_of(F.col("text"), shingle)
    met = docs.withColumns({"__id": _never_null("doc_id"), "__fp": own}).join(keep, ["__id", "__fp"])
    alone = Window.partitionBy("__id", "__fp").orderBy(F.xxhash64("text"))
    return (met.withColumn("__row", F.row_number().over(alone))
            .where("__row = 1").select(*names))


def _never_null(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id), F.lit(-(1 << 63)))
