"""Conversation repair against all repairs written out, and against parsing with every cut."""

from __future__ import annotations

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fabpulse.llm import turn_repair
from fabpulse.llm.turn_repair import GAP, cheapest, join_cells, parse, turn_cell

KINDS = "suaoSUAOd"


def every_repair(kinds, room):
    """(cost, audit) of all edits with at most `room` insertions in a row that give an allowed order."""
    def options(kind):
        yield 3, "D", ""
        if kind != "d":
            extra = kind.isupper()
            yield extra, "K", kind.lower()
            yield extra + 2, "R", "u"
            yield extra + 2, "R", "a"

    gaps = [(0, "", "")]
    for n in range(1, room + 1):
        gaps += [(2 * n, "I" * n, ("ua" * n)[:n]), (2 * n, "I" * n, ("au" * n)[:n])]
    found = [(c, a, r) for c, a, r in gaps]
    for kind in kinds:
        found = list({(c + d + g, a + b + h, r + s + t) for c, a, r in found for d, b, s in options(kind)
                      for g, h, t in gaps})
    return min((c, a) for c, a, r in found if re.fullmatch("(s?(ua)+)?", r))


@settings(max_examples=120, deadline=None)
@given(st.text(KINDS, max_size=3))
def test_cheapest_of_all_repairs(kinds):
    assert cheapest(parse(kinds)) == every_repair(kinds, 2)


def every_cut(kinds):
    """The span's cell from all cuts of all spans."""
    cells = {(i, i + 1): turn_cell(kind) for i, kind in enumerate(kinds)}
    for length in range(2, len(kinds) + 1):
        for low in range(len(kinds) - length + 1):
            high = low + length
            options = [join_cells(cells[low, cut], cells[cut, high]) for cut in range(low + 1, high)]
            cells[low, high] = tuple(
                min((cell[at] for cell in options if cell[at] is not None), default=None) for at in range(len(GAP)))
    return cells.get((0, len(kinds)), GAP)


@settings(max_examples=150, deadline=None)
@given(st.text(KINDS, max_size=24))
def test_one_cut_is_as_good_as_all(kinds):
    assert parse(kinds) == every_cut(kinds)


WHITE = "[\x20\x09-\x0D]"


def brute(turns):
    """The contract's columns of one conversation's rows (turn, role, text) after damage."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    kinds, seen, faults = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        bare = re.sub(WHITE, "", text)
        if not bare:
            kinds, fault = kinds + "d", "blank"
        elif (role, text) in seen:
            kinds, fault = kinds + "d", "duplicate"
        elif bare[-1] not in ".!?":
            kinds, fault = kinds + initial.upper(), "truncated"
        else:
            kinds, fault = kinds + initial, None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = cheapest(every_cut(kinds)) if rows else (0, "")
    lines, left, odd = [], iter(rows), (len(audit) - audit.count("D")) % 2
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit != "D":
            out = "user" if (len(lines) - odd) % 2 == 0 else "assistant"
            lines.append(f"{row[1]}:{row[2]}" if edit == "K" else f"{out}:" + ("" if row is None else row[2]))
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_damaged(turns):
    """By conversation, of all rows (conv_id, turn, role, text)."""
    left = {}
    for conv, turn, role, text in turns:
        rows = left.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2 and text is not None:
            text = re.sub("[.!?]", "", text)
        rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {conv: brute(rows) for conv, rows in left.items()}


@pytest.fixture
def turns(llm):
    def build(rows):
        return llm.createDataFrame(
            [(*row, "x", 1, True) for row in rows],
            "conv_id long, turn long, role string, text string, copies string, n int, first boolean")
    return build


def found(turns, rows, block):
    return {r[0]: tuple(r)[1:] for r in turn_repair.repair_damaged(turns(rows), block).collect()}


CONVERSATIONS = [
    *[(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(60)],
    *[(2, t, ("user", "system", "tool", None, "")[t % 5], f"Again {t % 7}") for t in range(45)],
    *[(None, t, "user", None) for t in range(3)], (None, None, "assistant", "No number."),
    (None, None, "assistant", "No number."), (3, 0, "user", ""), (3, 1, "user", " \t\n"), (4, 9, "system", "Only!"),
    (5, 0, "user", "Line\nline. "), (5, 3, "assistant", "Very long " * 30_000 + "."), (5, 3, "assistant", "Other?"),
    *[(6, 1, "assistant", "Copied whole.")] * 40, *[(6, t, "user", "The same text!") for t in range(2, 30)],
    *[(7, None, r, f"Untimed {i}.") for i, r in enumerate(["user", "assistant", "weird", "user"])],
]


@pytest.mark.parametrize("block", [3, 1024])
def test_conversations_of_all_kinds(turns, block):
    assert found(turns, CONVERSATIONS, block) == brute_damaged(CONVERSATIONS)


def test_no_rows_and_no_rows_left(turns):
    assert found(turns, [], 4) == {}
    dropped = next((c, t) for c in range(50) for t in range(50) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(turns, [(*dropped, "user", "Gone.")], 4) == {dropped[0]: (0, 0, 0, 0, 0, 0, "", empty)}


def test_repaired_turns(turns):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "And?"), (1, 3, "user", " ")]
    repair = turn_repair.Repair(turns(rows), 2)
    assert repair.report.first()["audit"] == "KIKKDI"
    assert [tuple(r)[1:] for r in repair.turns.orderBy("place").collect()] == [
        (0, "K", "system", "Be brief."), (1, "I", "user", ""), (2, "K", "assistant", "Hello."),
        (3, "K", "user", "And?"), (5, "I", "assistant", "")]
