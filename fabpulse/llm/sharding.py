"""Balanced label propagation: linked documents gather in shards that hold equally many rows.

Documents start on the shard their hash names. In each round the links are counted by shard, every
linked document learns by a join where most of its neighbours are, and asks to move there. How many may
go from one shard to another follows from the requests and the quotas: a move is granted if it is
met by one the other way, or if the target's linked rows are still below its size. Who goes is decided by a hash, of the
link, so that neighbours go together, or of the document where a group is large beside a shard.
At the end what is too much in one shard, unlinked documents first, fills up the others, so that
sizes are at most one apart.

It is DataFrame code throughout. Counts are aggregated before any join, a link with a third of all
rows may be split by the join, ranks run over hash ranges, and the driver sees counts per pair of
shards only.

Defined results: a null text has size 8, checksum 0 and no links. Rows that repeat doc_id and text
are numbered and placed one by one. Null ids are ids like others. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fabpulse.llm.scratch import stored

SHARDS, ROUNDS = 24, 4
QUOTA = 1.25  # linked rows that a shard may hold between rounds, in fair sizes
RANGES = 1 << 12  # hash ranges of a shard, for ranks
SCALE = 1 << 20  # of granted shares
LARGE = 64  # a group is large from this part of a shard on


def _share_table(grants: dict[tuple[int, int], int]) -> Column:
    """A lookup of at most shards * shards granted shares."""
    pairs = [F.lit(x) for (of, to), grant in sorted(grants.items()) for x in (of * 1_000 + to, grant)]
    return F.create_map(*pairs)


def grant(requests: dict[tuple[int, int], int], loads: list[int],
          quota: int) -> dict[tuple[int, int], int]:
    """For each (from, to) the share of its requests that is granted, in parts of SCALE.

    Requests that meet pass. Of the rest, a shard takes as many as it has room below the quota.
    """
    meets = {(of, to): min(n, requests.get((to, of), 0)) for (of, to), n in requests.items()}
    waiting = {pair: n - meets[pair] for pair, n in requests.items()}
    asked = [sum(n for (_, to), n in waiting.items() if to == shard) for shard in range(len(loads))]
    grants = {}
    for (of, to), n in requests.items():
        free = max(0, quota - loads[to])
        extra = min(waiting[of, to], free * waiting[of, to] // max(1, asked[to]))
        grants[of, to] = SCALE * (meets[of, to] + extra) // max(1, n)
    return grants


def _loads(placed: DataFrame, shards: int) -> list[int]:
    counts = {row["shard"]: row["count"] for row in placed.groupBy("shard").count().collect()}
    return [counts.get(shard, 0) for shard in range(shards)]


def propagate(nodes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Add `shard` and `kind` to rows with a `link` (null: none) and a `draw`, a hash of the row.

    Kinds: 0 unlinked, 1 of a group that is large beside a shard, 2 of a smaller one. Sizes are
    not even yet; `even_out` makes them so.
    """
    several = nodes.where("link is not null").groupBy("link").agg(F.count("*").alias("members"))
    several = several.where("members > 1")
    start = stored(
        nodes.join(several, "link", "left")
        .withColumn("shard", F.pmod("draw", F.lit(shards)).cast("int")), "start")
    alone = start.where("members is null")
    linked = start.where("members is not null")
    fair = max(1, start.count() // shards)
    quota = int(QUOTA * fair) + 1
    for turn in range(rounds):
        votes = linked.groupBy("link", "shard").agg(F.count("*").alias("votes"))
        favourite = votes.groupBy("link").agg(F.max(F.struct(
            "votes", F.xxhash64("link", "shard").alias("tie"), "shard")).alias("most"))
        wishes = stored(linked.join(favourite, "link").select(
            *linked.columns, F.col("most.shard").alias("wish")), f"round-{turn}")
        counts = wishes.groupBy("shard", "wish").count().collect()  # shards * shards rows at most
        loads = [0] * shards  # of linked rows: unlinked ones make way at no cost
        for row in counts:
            loads[row["shard"]] += row["count"]
        requests = {(r["shard"], r["wish"]): r["count"] for r in counts if r["shard"] != r["wish"]}
        if not requests:
            break
        share = _share_table(grant(requests, loads, quota))[F.col("shard") * 1_000 + F.col("wish")]
        together = F.when(F.col("members") > fair // LARGE, F.col("draw")).otherwise(F.xxhash64("link"))
        goes = F.pmod(F.xxhash64(together, F.lit(turn)), F.lit(SCALE)) < share
        linked = wishes.withColumn("shard", F.when(
            (F.col("shard") != F.col("wish")) & goes, F.col("wish")).otherwise(F.col("shard"))
        ).drop("wish")
    kind = F.when(F.col("members").isNull(), 0).when(F.col("members") > fair // LARGE, 1).otherwise(2)
    return alone.unionByName(linked).withColumn("kind", kind).drop("members")


def _by_bounds(value: Column, sizes: list[int]) -> tuple[Column, Column]:
    """Which of the consecutive intervals of these sizes holds a number, and where it begins."""
    which, begin, low = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    cases = []
    for number, size in enumerate(sizes):
        if size:
            cases.append((low + size, number, low))
        low += size
    for high, number, first in reversed(cases):
        which = F.when(value < high, F.lit(number)).otherwise(which)
        begin = F.when(value < high, F.lit(first).cast("long")).otherwise(begin)
    return which, begin


def _lookup(values: list[int]) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), F.col("shard") + 1)


def even_out(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Move the least that makes row counts at most one apart, and number each shard's rows: `slot`.

    Unlinked rows go first, then rows of large groups, then smaller groups one after the other.
    `draw` should differ from row to row.
    """
    loads = _loads(placed, shards)
    total = sum(loads)
    fair = [total // shards + (shard < total % shards) for shard in range(shards)]
    over = [max(0, load - size) for load, size in zip(loads, fair)]
    under = [max(0, size - load) for load, size in zip(loads, fair)]
    ranged = placed.withColumn(
        "order", F.when(F.col("kind") == 2, F.xxhash64("link")).otherwise(F.col("draw"))
    ).withColumn("range", F.pmod(F.shiftrightunsigned("order", 20), F.lit(RANGES)))
    earlier = Window.partitionBy("shard").orderBy("kind", "range").rowsBetween(
        Window.unboundedPreceding, -1)
    ahead = (
        ranged.groupBy("shard", "kind", "range").agg(F.count("*").alias("n"))
        .withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    )
    inside = Window.partitionBy("shard", "kind", "range").orderBy("order", "link", "draw")
    ranked = (
        ranged.withColumn("inside", F.row_number().over(inside) - 1)
        .join(ahead, ["shard", "kind", "range"])
        .withColumn("rank", F.col("ahead") + F.col("inside"))
    )
    leaves = F.col("rank") < _lookup(over)
    queue = F.col("rank") + _lookup([sum(over[:shard]) for shard in range(shards)])
    target, begin = _by_bounds(queue, under)
    full = F.element_at(F.array(*(F.lit(v).cast("long") for v in loads)), target + 1)
    return ranked.select(
        *placed.columns,
        F.when(leaves, target).otherwise(F.col("shard")).alias("new_shard"),
        F.when(leaves, full + queue - begin).otherwise(F.col("rank") - _lookup(over)).alias("slot"),
    ).withColumn("shard", F.col("new_shard")).drop("new_shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard); equal texts are linked."""
    known = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.md5("text").alias("link"))
    # Repeated rows are counted, then numbered, so that each row has a hash of its own.
    nodes = (
        known.groupBy(*known.columns).agg(F.count("*").alias("copies"))
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
        .withColumn("draw", F.xxhash64("doc_id", "link", "copy")).drop("copies")
    )
    placed = stored(propagate(nodes, shards, rounds), "placed")
    return even_out(placed, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
