from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from fabpulse.llm import simhash
from fabpulse.llm.components import components


def brute_fingerprint(text, width=3):
    import re
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    label = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("text", [
    None, "", " \n", "One", "one two", "One Two three", "a b c d", "É é Ü ß x y z w",
    "word " * 50_000, " ".join(str(i) for i in range(40_000))])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("crowd", [1, 3, 64])
def test_links_equal_brute_force(llm, crowd):
    rng = random.Random(4)
    prints = [0, 1, 3, (1 << 64) - 1, (1 << 63) | 1]
    for _ in range(12):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
                            for _ in range(6)]
        prints += [base ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)]
    prints = sorted(set(prints))
    df = llm.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r.node: r.root for r in components(simhash.fingerprint_links(df, crowd)).collect()}
    mine = [roots.get(signed(p), signed(p)) for p in prints]
    theirs = brute_classes(prints)
    assert len(set(zip(mine, theirs))) == len(set(mine)) == len(set(theirs))


def test_near_duplicates_and_the_one_kept(documents):
    rng = random.Random(1)
    base = [f"w{rng.randrange(10_000)}" for _ in range(400)]
    near = [*base[:200], "changed", *base[201:]]
    rows = [(7, " ".join(base)), (3, " ".join(near)), (3, " ".join(near)), (5, " ".join(base).upper()),
            (9, "other text entirely"), (None, " ".join(base)), (None, "nameless"), (None, "nameless"),
            (2, None), (4, ""), (9, "a second text with that id")]
    docs = documents(*rows)
    found = simhash.near_duplicates(docs).collect()
    prints = [simhash.fingerprint(t) for _, t in rows]
    classes = brute_classes(prints)
    least = {c: min((i for (i, _), k in zip(rows, classes) if k == c and i is not None), default=None)
             for c in classes}
    expected = sorted(((i, signed(p), least[c]) for (i, _), p, c in zip(rows, prints, classes)), key=repr)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found), key=repr) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    heads = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert len(heads) == len(set(classes))
    assert (True, 0, "nameless") in heads
    assert {h[1] for h in heads if not h[0]} == {x for x in least.values() if x is not None}


def test_empty_table(documents):
    empty = documents((1, "a")).limit(0)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_components_of_a_long_chain_and_a_hub(llm):
    edges = [(i, i + 1) for i in range(60)] + [(1_000, i) for i in range(100, 200)] + [(5, 5), (None, 3)]
    found = {r.node: r.root for r in components(llm.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in [*range(100, 200), 1_000]}}


def test_an_id_of_many_rows_and_heads_makes_no_pairs(documents, monkeypatch, tmp_path):
    words = [f"{a}{b}" for a in "bcdfghjk" for b in "aeiou"]
    texts = [" ".join(words[(7 * i + j * j * (i + 1)) % 40] for j in range(60)) for i in range(60)]
    docs = documents(*((None if i % 2 else 7, text) for i, text in enumerate(texts)), (7, texts[0]))
    seen = str(tmp_path / "seen")
    real = simhash.fingerprint

    def counted(text, shingle=3):
        with open(seen, "a") as file:
            file.write(".")
        return real(text, shingle)

    monkeypatch.setattr(simhash, "fingerprint_of", _counting(counted))
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len(set(brute_classes([brute_fingerprint(t) for t in texts])))
    assert len({r.text for r in kept}) == len(kept)
    with open(seen) as file:
        assert len(file.read()) <= 2 * docs.count()  # once for the components, once for the heads


def _counting(counted):
    def column(text, shingle=3):
        @F.udf("bigint")
        def signed(value):
            found = counted(value, shingle)
            return found - (1 << 64) if found >> 63 else found

        return signed.asNondeterministic()(text)

    return column
