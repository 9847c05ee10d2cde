"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fabpulse.llm.scratch import stored
from fabpulse.session import observing


def _with_least(pairs: DataFrame) -> DataFrame:
    """Add to each pair (u, v) the least node among u and its partners.

    The minimum is aggregated before the join, and the join may split a hub's rows. Both sides are as
    long as the edges, so they are merged: broadcasts of many rounds would stay on the driver.
    """
    least = (pairs.groupBy("u").agg(F.min("v").alias("least"))
             .select("u", F.least("u", "least").alias("least")))
    return pairs.hint("merge").join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_least(both).where("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` run from larger to smaller nodes."""
    found = _with_least(edges)
    return (
        found.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v")
        .union(found.select("u", F.col("least").alias("v"))).distinct()
    )


def _kept(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a table, and what tells edge sets apart; both come from one job.

    Both stars leave a finished set as it is. A task that runs twice could only make sets differ.
    """
    mark = Observation()
    with observing(edges.sparkSession):
        table = stored(edges.observe(
            mark, F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")), "edges")
    return table, mark.get


def components(edges: DataFrame) -> DataFrame:
    """From links (u, v) of comparable nodes: (node, root), the least node of each component.

    Nodes without a link to another are left out, null nodes too. Repeated links, links in both
    directions and links of a node to itself are allowed; no links give no rows. The number of
    rounds grows with the logarithm of the longest chain; each is one job that writes a table.
    """
    now, mark = _kept(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v").distinct())
    before = None
    while mark != before:
        before = mark
        now, mark = _kept(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v").distinct())
