"""Repair of conversation structure by weighted interval parsing.

A repaired conversation is empty or has roles whose initials spell `s?(ua)+`. A turn may be kept (cost 0), given
the role user or assistant (2) or deleted (3, the only choice for a blank or repeated turn), an empty turn of a
user or assistant inserted anywhere (2), and a truncated turn that stays costs 1. Of the cheapest repairs the
one whose edits, as initials in order, come first in ASCII wins.

The grammar is in Chomsky normal form: its nonterminals are the pairs (p, q) of the pattern's states, read
"leads from p to q"; (p, r) derives (p, q) (q, r), or a turn's edit, or insertions alone. A cell holds
each nonterminal's least (cost, audit) over a span of turns. Insertions are closed over before and after every
turn, so that joining cells needs no further ones. Two cheapest audits of a span never begin with one another
(the letters give the cost), so the least audits of neighbours join to the least of both. As any cut of a span
offers all middle states q, every cut gives the same cell: one cut a span is enough, and spans are combined
bottom-up by length, 1, 2, 4, ..., a conversation of n turns in n joins.

A conversation of any size is spread over tasks: turns are put in order by one range partitioning, blocks of
at most 1,024 turns are parsed apart, and only cells meet in one place, a few bytes a turn. The audit
found there is cut at the blocks again, which carry out their edits by themselves.

Cases: null roles and texts count as one space, so a null text is blank. Null conversation ids are one
conversation, null turns come first. Rows of equal conversation and turn are in the order of role, then of
the text's SHA-256; equal rows stand side by side, and all but the first are duplicates. Texts without a
character but white space are blank, texts of any length are read whole, but only their digests are ordered.
An empty table gives no rows. Columns beside those named are not read, whatever their names. A conversation's
audit is one value, which limits it to two billion edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabpulse.llm.checksums import CRC_TABLE, crc_sql
from fabpulse.llm.scratch import stored

BLOCK = 1024  # turns that are parsed in one piece

# What separates words, what ends a sentence, and the price of each edit.
WHITE = "\t\n\x0b\f\r "
ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# --- The grammar -----------------------------------------------------------------------

# States of s?(ua)*, empty or at least once: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)

Entry = tuple[int, str]
Cell = tuple[Entry | None, ...]

_REACHED = {START: (START, SYSTEM, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT),
            USER: (USER, ASSISTANT), ASSISTANT: (USER, ASSISTANT)}
NONTERMINALS = [(p, q) for p, reached in _REACHED.items() for q in reached]
_AT = {pair: at for at, pair in enumerate(NONTERMINALS)}
# For (p, r), where the cells of its two parts (p, q) and (q, r) are.
RULES = [[(_AT[p, q], _AT[q, r]) for q in _REACHED[p] if r in _REACHED[q]] for p, r in NONTERMINALS]


def join_cells(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    joined = []
    for parts in RULES:
        best = None
        for one, other in parts:
            if (a := left[one]) is not None and (b := right[other]) is not None:
                entry = (a[0] + b[0], a[1] + b[1])
                if best is None or entry < best:
                    best = entry
        joined.append(best)
    return tuple(joined)


def _insertions() -> Cell:
    """The cell of no turns: insertions only, of users and assistants."""
    cell: list[Entry | None] = [None] * len(NONTERMINALS)
    for p, q in NONTERMINALS:
        at, count = p, 0
        while at != q and count < len(_REACHED):
            at, count = next((MOVES[at, x] for x in "ua" if (at, x) in MOVES)), count + 1
        if at == q:
            cell[_AT[p, q]] = (INSERT * count, "I" * count)
    return tuple(cell)


GAP = _insertions()


@lru_cache(maxsize=None)
def turn_cell(kind: str) -> Cell:
    """The cell of one turn, with insertions around it.

    A kind is the role's initial, `o` for any other, in upper case if the turn is truncated; `d` if it must go.
    """
    cell: list[Entry | None] = [None] * len(NONTERMINALS)

    def offer(p: int, q: int, entry: Entry) -> None:
        at = _AT[p, q]
        if cell[at] is None or entry < cell[at]:
            cell[at] = entry

    for p in _REACHED:
        offer(p, p, (DELETE, "D"))
    if kind != "d":
        extra = TRUNCATED if kind.isupper() else 0
        for (p, symbol), q in MOVES.items():
            if symbol == kind.lower():
                offer(p, q, (extra, "K"))
            if symbol in "ua":
                offer(p, q, (extra + REROLE, "R"))
    return join_cells(join_cells(GAP, tuple(cell)), GAP)


@lru_cache(maxsize=1 << 15)
def _short_span(kinds: str) -> Cell:
    if len(kinds) == 1:
        return turn_cell(kinds)
    half = 1 << ((len(kinds) - 1).bit_length() - 1)
    return join_cells(_short_span(kinds[:half]), _short_span(kinds[half:]))


def combine(cells: list[Cell]) -> Cell:
    """The cell of many spans in a row, combined bottom-up by length."""
    if not cells:
        return GAP
    while len(cells) > 1:
        pairs = [join_cells(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(cells) & ~1:]
    return cells[0]


def parse(kinds: str) -> Cell:
    """The cell of a span of turns; spans of up to eight turns are remembered by their kinds."""
    return combine([_short_span(kinds[low:low + 8]) for low in range(0, len(kinds), 8)])


def cheapest(cell: Cell) -> Entry:
    """Least cost and audit of a whole conversation."""
    return min(cell[_AT[START, q]] for q in ACCEPTED)


def cut(audit: str, turns: list[int]) -> list[int]:
    """Where the audit's parts for runs of so many turns end; insertions go with the turn after them."""
    ends, at = [], 0
    for count in turns:
        while count:
            at += 1
            count -= audit[at - 1] != "I"
        ends.append(at)
    ends[-1:] = [len(audit)] * bool(ends)
    return ends


def edits(audit: str, copies: list[int], first: int, odd: bool) -> list[tuple[int, str, str, int]]:
    """(offset, edit, role, number of the row) of what stays, of rows that stand for some equal turns each.

    `first` roles precede in the conversation, whose repaired turns are odd in number if it starts with s.
    """
    found, row, left = [], 0, copies[0] if copies else 0
    for offset, edit in enumerate(audit):
        if edit != "D":
            symbol = "s" if odd and first == 0 else "ua"[(first - odd) % 2]
            found.append((offset, edit, symbol, -1 if edit == "I" else row))
            first += 1
        if edit != "I":
            left -= 1
            if not left and row + 1 < len(copies):
                row += 1
                left = copies[row]
    return found


# --- Turns in order --------------------------------------------------------------------


def _runs(turns: DataFrame) -> DataFrame:
    """Equal rows as one, with what can be told of each by itself."""
    space = F.lit(" ")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    return stored(
        rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
        .withColumns({"digest": F.sha2("text", 256), "blank": last == "", "open": ~last.isin(*ENDS)}), "turns")


def _same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    condition = F.lit(True)
    for column in columns:
        condition = condition & left[column].eqNullSafe(right[column])
    return condition


def _blocks(runs: DataFrame, size: int) -> DataFrame:
    """Blocks of consecutive turns, by conversation, partition and number in it.

    A turn is a duplicate if it isn't the first of its role and text: the first ones are aggregated, and
    joined by the turn as well, so no key has more than one row on either side.
    """
    slim = runs.drop("text")
    first = slim.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("at")) \
        .select("conv_id", "role", "digest", "at.turn", F.lit(True).alias("first"))
    met = slim.join(first, _same(slim, first, "conv_id", "turn", "role", "digest"), "left").select(
        slim["*"], F.coalesce(first["first"], F.lit(False)).alias("first"))
    order = ["turn", "role", "digest"]
    placed = met.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    number = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)) - 1
    initial = F.substring("role", 1, 1)
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    stays = F.col("first") & ~F.col("blank")
    kind = F.when(stays, F.when(F.col("open"), F.upper(symbol)).otherwise(symbol)).otherwise("d")
    copies = F.col("copies").cast("int")
    sums = {
        "blank": F.when(F.col("blank"), F.col("copies")),
        "duplicate": F.when(~F.col("blank"), F.col("copies") - F.col("first").cast("int")),
        "truncated": F.when(stays & F.col("open"), 1),
    }
    grouped = placed.withColumn("block", F.floor(number / size)).groupBy("conv_id", "part", "block").agg(
        F.sort_array(F.collect_list(F.struct(
            *order, copies.alias("copies"), F.repeat(symbol, copies).alias("initials"),
            F.concat(kind, F.repeat(F.lit("d"), copies - 1)).alias("kinds")))).alias("rows"),
        *[F.sum(F.coalesce(n, F.lit(0))).alias(name) for name, n in sums.items()],
        F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.count_distinct("turn").alias("turns"))

    def spelled(field: str) -> Column:
        return F.array_join(F.col(f"rows.{field}"), "")

    return stored(grouped.select(
        "conv_id", "part", "block",
        F.transform("rows", lambda r: F.struct(r["turn"], r["role"], r["digest"], r["copies"])).alias("rows"),
        spelled("initials").alias("initials"), spelled("kinds").alias("kinds"), *sums, "low", "high", "turns"),
        "blocks")


# --- Parsing ---------------------------------------------------------------------------

_ENTRIES = "array<struct<cost:bigint,audit:string>>"
_SETTLED = "struct<cost:bigint,audit:string,ends:array<bigint>,firsts:array<bigint>>"
_EDITS = "array<struct<place:bigint,edit:string,symbol:string,row:int>>"
_LEGAL = ("su", "ua", "au")


def _parse_blocks(kinds: pa.Array) -> pa.Array:
    found = [[None if e is None else {"cost": e[0], "audit": e[1]} for e in parse(k)] for k in kinds.to_pylist()]
    return pa.array(found, pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())])))


def _settle(cells: pa.Array, turns: pa.Array) -> pa.Array:
    """From the cells of a conversation's blocks and their counts of turns to its audit, cut at the blocks."""
    found = []
    for row, counts in zip(cells.to_pylist(), turns.to_pylist()):
        whole = combine([tuple(e and (e["cost"], e["audit"]) for e in cell) for cell in row])
        cost, audit = cheapest(whole)
        ends = cut(audit, counts)
        firsts, seen = [], 0
        for low, high in zip([0, *ends], ends):
            firsts.append(seen)
            seen += high - low - audit.count("D", low, high)
        found.append({"cost": cost, "audit": audit, "ends": ends, "firsts": firsts})
    return pa.array(found, pa.struct([
        ("cost", pa.int64()), ("audit", pa.string()), ("ends", pa.list_(pa.int64())),
        ("firsts", pa.list_(pa.int64()))]))


def _edit(audits: pa.Array, copies: pa.Array, starts: pa.Array, firsts: pa.Array, odds: pa.Array) -> pa.Array:
    columns = (c.to_pylist() for c in (audits, copies, starts, firsts, odds))
    found = [[{"place": start + at, "edit": edit, "symbol": symbol, "row": row}
              for at, edit, symbol, row in edits(audit, some, first, odd)]
             for audit, some, start, first, odd in zip(*columns)]
    return pa.array(found, pa.list_(pa.struct([
        ("place", pa.int64()), ("edit", pa.string()), ("symbol", pa.string()), ("row", pa.int32())])))


def _legal_pairs(initials: Column) -> Column:
    """Neighbours that may stand side by side; none of the pairs overlaps itself."""
    def times(pair: str) -> Column:
        return (F.length(initials) - F.length(F.replace(initials, F.lit(pair), F.lit("")))) / 2

    su, ua, au = map(times, _LEGAL)
    return (su + ua + au).cast("long")


def _conversations(blocks: DataFrame) -> DataFrame:
    """One row per conversation: its faults, cost, audit, and where the audit is cut at its blocks.

    Neighbours and turns that two blocks share are settled here, from their ends.
    """
    cells = blocks.withColumns({
        "cell": F.arrow_udf(_parse_blocks, _ENTRIES)("kinds"), "n": F.length("kinds").cast("long"),
        "illegal": F.length("initials") - 1 - _legal_pairs(F.col("initials")),
        "left": F.left("initials", F.lit(1)), "right": F.right("initials", F.lit(1)),
    })
    ends = ("part", "block", "cell", "n", "left", "right", "low", "high")
    grouped = cells.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "block", F.struct(*ends[2:]).alias("b")))).alias("blocks"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")],
        F.min("low").alias("low"), F.max("high").alias("high"))
    size = F.size("blocks")
    borders = F.zip_with(
        F.slice("blocks", 1, size - 1), F.slice("blocks", F.lit(2), size), lambda a, b: F.struct(
            F.concat(a["b"]["right"], b["b"]["left"]).isin(*_LEGAL).alias("legal"),
            F.coalesce(a["b"]["high"] == b["b"]["low"], F.lit(False)).alias("shared")))
    crossing = F.size(F.filter(borders, lambda x: ~x["legal"]))
    shared = F.size(F.filter(borders, lambda x: x["shared"]))
    gaps = F.col("high") - F.col("low") + 1 - (F.col("turns") - shared)
    return stored(grouped.select(
        "conv_id", F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        (F.col("illegal") + crossing).cast("long").alias("illegal"),
        F.arrow_udf(_settle, _SETTLED)("blocks.b.cell", "blocks.b.n").alias("found"),
        F.transform("blocks", lambda b: F.struct(b["part"], b["block"])).alias("blocks"),
    ).select("*", "found.*").drop("found"), "conversations")


class Repair:
    """What was found and done: `report` has a row per conversation, `turns` the repaired ones.

    `report`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. `turns`: conv_id, place (of the
    edit in the audit), edit, role, text.
    """

    def __init__(self, turns: DataFrame, block: int = BLOCK):
        runs = _runs(turns)
        blocks = _blocks(runs, block)
        found = _conversations(blocks)
        self.report = found.drop("ends", "firsts", "blocks")
        self.turns = _carry_out(runs, blocks, found)


def _carry_out(runs: DataFrame, blocks: DataFrame, found: DataFrame) -> DataFrame:
    kept = F.length(F.replace("audit", F.lit("D"), F.lit("")))
    starts = F.concat(F.array(F.lit(0).cast("long")), "ends")
    cuts = found.withColumn("starts", F.slice(starts, F.lit(1), F.size("ends"))).select(
        "conv_id", "audit", (kept % 2 == 1).alias("odd"),
        F.explode(F.arrays_zip("blocks", "ends", "firsts", "starts")).alias("c"),
    ).select(
        "conv_id", "c.blocks.part", "c.blocks.block", "odd", "c.firsts", "c.starts",
        F.substring("audit", F.col("c.starts") + 1, F.col("c.ends") - F.col("c.starts")).alias("audit"))
    both = blocks.join(cuts, _same(blocks, cuts, "conv_id", "part", "block"))
    done = both.select(blocks["conv_id"], "rows", F.explode(F.arrow_udf(_edit, _EDITS)(
        cuts["audit"], F.col("rows.copies"), "starts", "firsts", "odd")).alias("e")).select(
            "conv_id", "e.place", "e.edit", "e.symbol", F.get("rows", F.col("e.row")).alias("r"))
    named = F.when(F.col("symbol") == "u", "user").otherwise("assistant")
    inserted = done.where("edit = 'I'").select(
        "conv_id", "place", "edit", named.alias("role"), F.lit("").alias("text"))
    staying = done.where("edit <> 'I'").select("conv_id", "place", "edit", "symbol", "r.turn", "r.role", "r.digest")
    texts = runs.select("conv_id", "turn", "role", "digest", "text")
    kept_turns = staying.join(texts, _same(staying, texts, "conv_id", "turn", "role", "digest")).select(
        staying["conv_id"], "place", "edit",
        F.when(F.col("edit") == "K", staying["role"]).otherwise(named).alias("role"), "text")
    return kept_turns.unionByName(inserted)


# --- Damage and digests ----------------------------------------------------------------

_FAULTS = 20


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults that follow from a checksum of conversation and turn."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(name) % _FAULTS
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.select("conv_id", "turn", "role", "text").where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def text_digests(repaired: DataFrame) -> DataFrame:
    """Of each conversation the SHA-256 of its `role:text` lines.

    Such a digest can only be taken from first to last, so a conversation's turns pass through one task; they
    are sorted before and read one by one, none is kept.
    """
    lines = repaired.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").drop("place")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"conv_id": now[0], "repaired_sha256": state.hexdigest()}], schema)

        for batch in batches:
            schema = pa.schema([batch.schema.field("conv_id"), ("repaired_sha256", pa.string())])
            for conversation, line in zip(batch["conv_id"].to_pylist(), batch["line"].to_pylist()):
                if now != (conversation,):
                    if now is not None:
                        yield ended()
                    now, state = (conversation,), hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
        if now is not None:
            yield ended()

    kind = repaired.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(take, f"conv_id {kind}, repaired_sha256 string")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_damaged(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every conversation of a table, damaged and repaired."""
    repair = Repair(damaged(turns), block)
    every = turns.select("conv_id").distinct()
    report, digests = repair.report, text_digests(repair.turns)
    both = every.join(report, _same(every, report, "conv_id"), "left").select(
        every["conv_id"], *[F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"))
    empty = hashlib.sha256(b"").hexdigest()
    return both.join(digests, _same(both, digests, "conv_id"), "left").select(
        both["*"], F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


# --- The same in SQL: one turn after the other, least (cost, audit) of each state -------

ORACLE = rf"""WITH RECURSIVE {CRC_TABLE},
named AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
faults AS (SELECT conv_id, turn, role, text, {crc_sql("name")} % 20 AS fault FROM named, crc),
damaged AS (SELECT conv_id, turn, coalesce(CASE WHEN fault = 4 THEN 'user' ELSE role END, ' ') AS role,
  coalesce(CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END, ' ') AS text,
  unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM faults WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (
  PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n FROM damaged),
judged AS (SELECT conv_id, turn, role, text, n, substr(role, 1, 1) AS initial,
  NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open FROM placed),
turns AS (SELECT *, blank OR again AS must,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM judged),
counts AS (SELECT conv_id, count(*) AS rows,
  coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count_if(blank)::BIGINT AS blank, count_if(again AND NOT blank)::BIGINT AS duplicate,
  count_if(open AND NOT must)::BIGINT AS truncated, count_if(coalesce(illegal, false))::BIGINT AS illegal
  FROM turns GROUP BY conv_id),
moves(p, symbol, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserted(p, q, cost, audit) AS (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'),
  (1, 3, 4, 'II'), (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
steps(p, q, cost, edit, symbol) AS (SELECT p, q, 0, 'K', symbol FROM moves UNION ALL
  SELECT p, q, 2, 'R', NULL FROM moves WHERE symbol <> 's' UNION ALL SELECT p, p, 3, 'D', NULL FROM range(4) AS s(p)),
best(conv_id, n, q, found) AS (
  SELECT conv_id, 0, q, {{'cost': cost, 'audit': audit}} FROM counts, inserted WHERE p = 0
  UNION ALL
  SELECT b.conv_id, b.n + 1, i.q, min({{
    'cost': b.found.cost + s.cost + (CASE WHEN t.open AND s.edit <> 'D' THEN 1 ELSE 0 END) + i.cost,
    'audit': b.found.audit || s.edit || i.audit}})
  FROM best AS b JOIN turns AS t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.n = b.n + 1
  JOIN steps AS s ON s.p = b.q AND (s.edit = 'D' OR NOT t.must) AND (s.edit <> 'K' OR s.symbol = t.initial)
  JOIN inserted AS i ON i.p = s.q GROUP BY b.conv_id, b.n, i.q),
cheapest AS (SELECT c.conv_id, min(b.found) AS found FROM counts AS c
  JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.n = c.rows AND b.q IN (0, 3) GROUP BY c.conv_id),
letters AS (SELECT conv_id, i, substr(found.audit, i, 1) AS edit FROM
  (SELECT conv_id, found, unnest(range(1, length(found.audit) + 1)) AS i FROM cheapest)),
edits AS (SELECT conv_id, i, edit, count_if(edit <> 'I') OVER upto AS n, count_if(edit <> 'D') OVER upto AS out,
  count_if(edit <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM letters
  WINDOW upto AS (PARTITION BY conv_id ORDER BY i)),
lines AS (SELECT e.conv_id, e.i, CASE WHEN edit = 'K' THEN t.role WHEN (out - odd) % 2 = 1 THEN 'user'
  ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE t.text END AS line
  FROM edits AS e LEFT JOIN turns AS t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.n = e.n WHERE edit <> 'D'),
digests AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY i)) AS d FROM lines GROUP BY conv_id)
SELECT a.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
  coalesce(b.found.cost, 0)::BIGINT AS cost, coalesce(b.found.audit, '') AS audit,
  coalesce(d.d, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS a
LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN cheapest AS b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN digests AS d ON d.conv_id IS NOT DISTINCT FROM a.conv_id"""
