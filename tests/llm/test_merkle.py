"""The Merkle manifest against trees built whole, and its log against positions counted."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fabpulse.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, source, lang, n_chars, _ = row
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def levels(nodes):
    """All levels of a tree, the whole of it in memory."""
    found = [nodes]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([h("".join(below[low:low + 8])) for low in range(0, len(below), 8)])
    return found


def siblings(tree, at):
    found = []
    for level in tree[:-1]:
        run = range(at // 8 * 8, min(at // 8 * 8 + 8, len(level)))
        found.append((at % 8, [level[i] for i in run if i != at]))
        at //= 8
    return found


def folded(node, path):
    for slot, others in path:
        node = h("".join([*others[:slot], node, *others[slot:]]))
    return node


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0], leaf(row, row[4]), row))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0], r[1] or 0, r[2]))
    built = {name: levels([r[2] for r in trees[name]]) for name in names}
    over = levels([built[name][-1][0] for name in names])
    found = []
    for number, name in enumerate(names):
        for at, (_, doc_id, own, row) in enumerate(trees[name]):
            path = siblings(built[name], at) + siblings(over, number)
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row[4] is not None
            text = row[4]
            if tampered:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            root = folded(leaf(row, text), path)
            found.append((doc_id, own, built[name][-1][0], over[-1][0],
                          h("".join(s for _, others in path for s in others)), root, root == over[-1][0]))
    return sorted(found, key=repr)


def audited(documents, rows, height):
    docs = documents(*[(i, text, lang, source) for i, source, lang, text in rows])
    found = sorted(map(tuple, merkle.audit_documents(docs, height).collect()), key=repr)
    whole = [(i, source, lang, None if text is None else len(text), text) for i, source, lang, text in rows]
    return found, brute(whole)


@pytest.mark.parametrize("height", [1, 2, 4])
def test_every_proof_of_trees_of_all_kinds(documents, height):
    rows = [(i, "web", "en", f"Text {i}") for i in range(139)]
    rows += [(i, "web", "de", "ÄB é" * (i % 3)) for i in range(200, 264)]
    rows += [(400, None, "fr", None), (401, "", None, ""), (402, "s", "", "Alone"), (None, "s", "fr", "No Id"),
             (7, "web", "en", "Text 7"), (7, "web", "en", "Another"), (500, "s", "zz", "Long " * 50_000)]
    found, wanted = audited(documents, rows, height)
    assert found == wanted
    assert {row[-1] for row in found} == {True, False}


def test_many_trees(documents):
    found, wanted = audited(documents, [(i, "s", f"l{i % 75}", f"T{i}") for i in range(150)], 1)
    assert found == wanted


def test_repeated_rows_are_leaves_of_their_own(documents):
    found, wanted = audited(documents, [(3, "s", "en", "Same")] * 90, 1)
    assert found == wanted and len(found) == 90


def test_one_row_and_none(documents):
    found, wanted = audited(documents, [(1, "s", "en", "A")], 4)
    assert found == wanted and found[0][1] == found[0][3]
    assert audited(documents, [], 4) == ([], [])


def test_proofs_fold_to_the_root(documents):
    docs = documents(*[(i, f"T{i}", "en", "s") for i in range(100)])
    manifest = merkle.Manifest(docs, "lang", "doc_id", height=1)
    root = merkle.tops(manifest.over).first()["node"]
    rows = manifest.proofs().collect()
    assert len(rows) == 100
    for row in rows:
        path = [{"slot": s.slot, "siblings": list(map(bytes, s.siblings))} for s in row.path]
        assert merkle.fold(bytes(row.node), path) == bytes(root)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700), st.integers(0, 2))
def test_positions_are_those_of_the_log(leaves, more):
    levels_up = merkle.levels_of(leaves) + more
    log = merkle.append_log([i.to_bytes(32, "big") for i in range(leaves)], levels_up)
    nodes = [i.to_bytes(32, "big") for i in range(leaves)]
    seen = []
    for level in range(levels_up + 1):
        where = [merkle.position(level, n, leaves, levels_up) for n in range(len(nodes))]
        assert [log[at] for at in where] == nodes
        seen += where
        nodes = [merkle.digest(nodes[low:low + 8]) for low in range(0, len(nodes), 8)]
    assert sorted(seen) == list(range(len(log)))
