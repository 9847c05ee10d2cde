"""Mixing sources to target weights: temperature mixing with budgeted block permutations.

A source's weight is its share of all tokens, raised to an exponent between 0 (all equal) and 1 (as
they are) and normalised. The exponent is the smallest, found by bisection, at which the
weights' entropy is at most a target and no source repeats more often than a limit. A source's
budget is its weight's part of all tokens asked for. Its documents follow each other in a
permutation, drawn anew for each epoch by a hash, until the budget is used up: the document that reaches it is
the last, so a source exceeds its budget by less than that document, however long one is. Each source's stream
is cut into as many equal blocks; equal blocks of all sources make one block of the mixture, which
holds them at the target weights and is permuted in turn.

All of it is DataFrame code. Running sums over a source go by hash ranges: sums per range, a window
over the ranges, and a window inside each, so a source with a third of all rows is spread.

Tokens are words. A null or empty text has none and rides along where its hash puts it. A null
source is a source. Sources without any token are left out, and no documents give no rows.
Repeated rows are documents of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fabpulse.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 1 << 24  # exponents are multiples of 1 / STEPS
_HALVINGS = 6  # in one pass over the sources


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _fits(sources: DataFrame, total: int, budget: int, target: float, max_repeats: float,
          steps: list[int]) -> list[bool]:
    """For each exponent, whether entropy and repetition stay within their limits."""
    share = F.col("tokens") / F.lit(total)
    exponent = F.col("step") / F.lit(STEPS)
    rows = (
        sources.select("tokens", F.explode(F.array(*map(F.lit, steps))).alias("step"))
        .select("step", share.alias("p"), F.pow(share, exponent).alias("q"))
        .groupBy("step").agg(F.sum("q").alias("z"), F.sum(F.col("q") * F.log("p")).alias("l"),
                             F.max(F.col("q") / F.col("p")).alias("most"))
        .collect()
    )
    found = {row["step"]: (math.log(row["z"]) - row["step"] / STEPS * row["l"] / row["z"] <= target
                           and row["most"] / row["z"] * (budget / total) <= max_repeats)
             for row in rows}
    return [found[step] for step in steps]


def find_exponent(sources: DataFrame, budget: int, *, target_entropy: float,
                  max_repeats: float) -> int:
    """The exponent's numerator over STEPS; `sources` has a row of `tokens` for each.

    `target_entropy` is a share of the largest entropy, that of equal weights.
    """
    total, count = sources.agg(F.sum("tokens"), F.count("*")).first()
    low, high = 0, STEPS  # the answer is in between, and `high` is taken without a test
    while low < high:
        width = max(1, (high - low) >> _HALVINGS)
        steps = list(range(low, high, width))
        fits = _fits(sources, total, budget, target_entropy * math.log(count), max_repeats, steps)
        first = fits.index(True) if True in fits else len(steps)
        high = steps[first] if first < len(steps) else high
        low = steps[first - 1] + 1 if first else high
    return high


def _draw(seed: str, *parts: str) -> Column:
    """A permutation's sort key: the same in any SQL engine."""
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.col(part).cast("string") for part in parts)))


def mix(rows: DataFrame, *, budget: int | None = None, target_entropy: float = 0.95,
        max_repeats: float = 2.0, block_tokens: int = 1 << 18, seed: str = "mix") -> DataFrame:
    """One row per document taken and epoch: the input's columns, epoch, block and slot.

    `rows` has doc_id, source, n_tokens and a `mark` that tells rows of equal doc_id apart; it is
    read several times, so it should be stored. `budget` is in tokens; by default as many as there are.
    """
    sources = stored(
        rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "sources")
    total = sources.agg(F.sum("tokens")).first()[0]
    if total is None:
        return rows.limit(0).selectExpr("*", "0L as epoch", "0L as block", "0L as slot")
    budget = total if budget is None else budget
    step = find_exponent(sources, budget, target_entropy=target_entropy, max_repeats=max_repeats)
    blocks = max(1, -(-budget // block_tokens))
    power = F.pow(F.col("tokens") / F.lit(total), F.lit(step) / F.lit(STEPS))
    scale = sources.agg(F.sum(power)).first()[0]
    plan = (
        sources.withColumn("quota", F.floor(power / F.lit(scale) * F.lit(budget) + 0.5))
        .select(F.col("source").alias("of"), "tokens", "quota",
                F.expr(f"(quota + {blocks - 1}) div {blocks}").alias("per_block"),
                F.explode(F.expr("sequence(0L, quota div tokens)")).alias("epoch"))
    )
    drawn = (
        rows.join(plan, rows.source.eqNullSafe(plan.of)).drop("of")
        .withColumn("draw", _draw(seed, "epoch", "doc_id"))
        .withColumn("range", F.substring("draw", 1, 3))
    )
    # Running sums by ranges of the draw: 4,096 of them for each source and epoch.
    earlier = Window.partitionBy("of", "epoch").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    ranges = (
        drawn.groupBy(F.col("source").alias("of"), "epoch", "range")
        .agg(F.sum("n_tokens").alias("in_range"))
        .withColumn("ahead", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
        .select("of", F.col("epoch").alias("e"), F.col("range").alias("r"), "ahead")
    )
    inside = Window.partitionBy("source", "epoch", "range").orderBy(
        "draw", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        drawn.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("e"))
              & (F.col("range") == F.col("r")))
        .withColumn("at", F.expr("epoch * tokens + ahead + before"))
        .where("at < quota")
        .withColumn("block", F.expr("at div per_block"))
    )
    shuffled = Window.partitionBy("block").orderBy(
        _draw(f"{seed}:slot", "epoch", "doc_id"), "doc_id", "mark")
    return placed.withColumn("slot", (F.row_number().over(shuffled) - 1).cast("long")).select(
        *rows.columns, "epoch", "block", "slot")


def countable(docs: DataFrame) -> DataFrame:
    """What `mix` needs to know of documents, stored."""
    return stored(docs.select("doc_id", "source", word_count().alias("n_tokens"),
                              F.xxhash64("doc_id", "text").alias("mark")), "tokens")


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mixture, each as often as it is taken, with the columns of `docs`.

    Of rows that share doc_id and text, the other columns are those of one of them.
    """
    copies = (
        mix(countable(docs), **how).groupBy("doc_id", "mark").agg(F.count("*").alias("__copies"))
        .select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), "__copies")
    )
    marked = docs.withColumn("__own", F.xxhash64("doc_id", "text"))
    met = marked.join(copies, (F.col("__own") == F.col("__mark"))
                      & F.col("doc_id").eqNullSafe(F.col("__id")))
    one = Window.partitionBy("__own", "__id").orderBy("__mark")
    return (met.withColumn("__row", F.row_number().over(one)).where("__row = 1")
            .withColumn("__copy", F.explode(F.expr("sequence(1L, __copies)")))
            .select(*docs.columns))


# For DuckDB, with the default parameters: rows of (doc_id, source, n_tokens, epoch, block, slot).
ORACLE = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS n_tokens
    FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source HAVING sum(n_tokens) > 0),
t AS (SELECT sum(tokens)::BIGINT AS total, 0.95 * ln(count(*)) AS target,
             list(tokens) AS each_source FROM s),
search AS (
    SELECT 0 AS low, {STEPS} AS high
    UNION ALL
    SELECT CASE WHEN fits THEN low ELSE middle + 1 END, CASE WHEN fits THEN middle ELSE high END
    FROM (
        SELECT low, high, middle,
               ln(z) - a * l / z <= target AND most / z <= 2.0 AS fits
        FROM (
            SELECT low, high, middle, a, target,
                   list_sum([pow(x / total, a) for x in each_source]) AS z,
                   list_sum([pow(x / total, a) * ln(x / total) for x in each_source]) AS l,
                   list_max([pow(x / total, a) / (x / total) for x in each_source]) AS most
            FROM (SELECT *, (low + high) // 2 AS middle, ((low + high) // 2) / {STEPS}.0::DOUBLE AS a
                  FROM search, t WHERE low < high)))),
e AS (SELECT high / {STEPS}.0::DOUBLE AS a FROM search WHERE low >= high),
w AS (SELECT source, tokens, pow(tokens / total, a) AS power, total,
             sum(pow(tokens / total, a)) OVER () AS scale,
             greatest(1, (total + {(1 << 18) - 1}) // {1 << 18}) AS blocks FROM s, t, e),
q AS (SELECT source, tokens, blocks, floor(power / scale * total + 0.5)::BIGINT AS quota FROM w),
p AS (SELECT *, (quota + blocks - 1) // blocks AS per_block,
             unnest(range(0, quota // tokens + 1)) AS epoch FROM q),
r AS (SELECT d.*, p.tokens, p.quota, p.per_block, p.epoch,
             md5(concat_ws(':', 'mix', p.epoch, d.doc_id)) AS draw
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
o AS (SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (
                 PARTITION BY source, epoch ORDER BY draw, doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM r),
b AS (SELECT *, place // per_block AS block FROM o WHERE place < quota)
SELECT doc_id, source, n_tokens, epoch, block,
       row_number() OVER (PARTITION BY block
                          ORDER BY md5(concat_ws(':', 'mix:slot', epoch, doc_id)), doc_id) - 1 AS slot
FROM b
"""
