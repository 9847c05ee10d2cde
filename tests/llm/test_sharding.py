from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from fabpulse.llm import sharding


def check_law(found, shards=24):
    """Counts at most one apart, slots gapless."""
    slots = defaultdict(list)
    for row in found:
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[shard]) for shard in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    return found


def cut(found, key):
    """Of the neighbours in a chain of equal texts, the share in different shards."""
    groups = defaultdict(Counter)
    for row in found:
        groups[key(row)][row.shard] += 1
    linked = [g for g in groups.values() if sum(g.values()) > 1]
    return (sum(len(g) - 1 for g in linked) / max(1, sum(sum(g.values()) - 1 for g in linked)))


def test_groups_gather_and_sizes_are_even(documents):
    rows = [(i, f"group {i % 300}") for i in range(1_000)] + [(i, f"single {i}") for i in range(1_000, 3_005)]
    found = check_law(sharding.shard_documents(documents(*rows)).collect())
    texts = dict(rows)
    assert sorted((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in found) == [
        (i, len(t) + 8, zlib.crc32(t.encode()), "rows", None) for i, t in rows]
    assert cut(found, lambda r: texts[r.doc_id]) < 0.1


def test_a_group_of_a_third_of_all_rows(documents):
    rows = [(i, "hot") for i in range(400)] + [(i, f"pair {i // 2}") for i in range(400, 1_200)]
    found = check_law(sharding.shard_documents(documents(*rows)).collect())
    pairs = [r for r in found if r.doc_id >= 400]
    assert cut(pairs, lambda r: r.doc_id // 2) < 0.35


def test_hard_rows(documents):
    rows = [(1, "same")] * 70 + [(2, None), (2, None), (None, "x"), (None, None), (3, ""), (4, "é" * 100_000)]
    found = check_law(sharding.shard_documents(documents(*rows)).collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)


@pytest.mark.parametrize("count", [0, 1, 23, 25])
def test_few_rows(documents, count):
    docs = documents((-1, "x"), *((i, f"t{i % 5}") for i in range(count))).where("doc_id >= 0")
    assert len(check_law(sharding.shard_documents(docs).collect())) == count


def test_grants_keep_to_the_room():
    grants = sharding.grant({(0, 1): 100, (1, 0): 40, (2, 1): 30}, [50, 90, 50], 100)
    moved = {pair: n * grants[pair] // sharding.SCALE for pair, n in
             {(0, 1): 100, (1, 0): 40, (2, 1): 30}.items()}
    assert moved[1, 0] == 40
    assert 40 <= moved[0, 1] <= 50 and moved[0, 1] + moved[2, 1] - 40 <= 10


def test_rows_repeat_from_run_to_run(documents):
    docs = documents(*((i, f"t{i % 40}") for i in range(200)))
    first, again = (sorted(map(tuple, sharding.shard_documents(d).collect()), key=repr)
                    for d in (docs, docs.repartition(3)))
    assert first == again
