from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import pytest

from fabpulse.llm import mixing
from fabpulse.session import settle


def brute_mix(rows, target=0.95, limit=2.0, block_tokens=1 << 18):
    """rows: (doc_id, source, n_tokens), all different ids."""
    def draw(*parts):
        return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()

    tokens = Counter()
    for _, source, n in rows:
        tokens[source] += n
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    shares = {s: n / total for s, n in tokens.items()}

    def weights(step):
        power = {s: p ** (step / mixing.STEPS) for s, p in shares.items()}
        return {s: q / sum(power.values()) for s, q in power.items()}

    def fits(step):
        w = weights(step)
        entropy = -sum(x * math.log(x) for x in w.values())
        return (entropy <= target * math.log(len(w))
                and max(w[s] / shares[s] for s in w) <= limit)

    low, high = 0, mixing.STEPS
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    blocks = max(1, -(-total // block_tokens))
    taken = defaultdict(list)
    for s, w in weights(high).items():
        quota = math.floor(w * total + 0.5)
        for epoch in range(quota // tokens[s] + 1):
            at = epoch * tokens[s]
            for key, i, n in sorted((draw("mix", epoch, i), i, n) for i, of, n in rows if of == s):
                if at < quota:
                    taken[at // -(-quota // blocks)].append(
                        (draw("mix:slot", epoch, i), i, s, n, epoch))
                at += n
    return sorted((i, s, n, epoch, block, slot) for block, found in taken.items()
                  for slot, (_, i, s, n, epoch) in enumerate(sorted(found)))


def made(count=240):
    return [(i, "hot" if i % 3 == 0 else f"s{i % 7}", i * 37 % 50) for i in range(count)]


@pytest.mark.parametrize("how", [{}, {"target": 0.999}, {"limit": 1.05}, {"block_tokens": 500}])
def test_equals_brute_force(llm, how):
    rows = made()
    df = llm.createDataFrame([(*r, r[0]) for r in rows], "doc_id long, source string, n_tokens long, mark long")
    names = {"target": "target_entropy", "limit": "max_repeats"}
    found = mixing.mix(settle(df), **{names.get(k, k): v for k, v in how.items()}).drop("mark")
    assert sorted(map(tuple, found.collect())) == brute_mix(rows, **how)


def test_oracle_agrees(documents):
    docs = documents(*((i, "word " * n if n else None, None, s) for i, s, n in made()))
    found = mixing.mix(mixing.countable(docs)).drop("mark")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert sorted(map(tuple, found.collect())) == sorted(con.sql(mixing.ORACLE).fetchall())


def test_target_is_met(llm):
    sources = llm.createDataFrame([(t,) for t in (10_000, 500, 400, 300, 200)], "tokens long")
    shares = [t / 11_400 for t in (10_000, 500, 400, 300, 200)]
    step = mixing.find_exponent(sources, 11_400, target_entropy=0.5, max_repeats=99)
    power = [p ** (step / mixing.STEPS) for p in shares]
    entropy = -sum(q / sum(power) * math.log(q / sum(power)) for q in power)
    assert 0.499999 < entropy / math.log(5) <= 0.5
    assert mixing.find_exponent(sources, 11_400, target_entropy=0.01, max_repeats=99) == mixing.STEPS
    assert mixing.find_exponent(sources, 11_400, target_entropy=1.01, max_repeats=99) == 0


def test_hard_rows_and_whole_documents(documents):
    rows = [(i % 40, f"text of {i % 40} " * (i % 5), None, None if i % 4 else "a") for i in range(80)]
    rows += [(None, "no id here", None, "b"), (None, "nor here", None, "b"), (100, None, None, "c"),
             (101, "w " * 100_000, None, "b")]
    docs = documents(*rows)
    counted = mixing.mix(mixing.countable(docs))
    taken = Counter((r.doc_id, r.mark) for r in counted.collect())
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(taken.values())
    known = {(i, t, s) for i, t, _, s in rows}
    assert {(r.doc_id, r.text, r.source) for r in mixed.collect()} <= known


def test_no_tokens(documents):
    for docs in (documents((1, None), (2, "")), documents((1, "a")).limit(0)):
        mixed = mixing.mix(mixing.countable(docs))
        assert mixed.count() == 0 and mixed.columns[-3:] == ["epoch", "block", "slot"]
        assert mixing.mix_documents(docs).count() == 0


def test_a_dominating_document_costs_no_source_its_quota(documents):
    rows = [(i, "word " * 10, None, "big") for i in range(1000)] + [(1000, "word " * 40_000, None, "big")]
    rows += [(2000 + i, "word " * 100, None, s) for s in ("b", "c") for i in range(150)]
    rows = [(k, *row[1:]) for k, row in enumerate(rows)]
    counted = mixing.countable(documents(*rows))
    taken = Counter()
    for r in mixing.mix(counted).collect():
        taken[r.source] += r.n_tokens
    tokens = {"big": 50_000, "b": 15_000, "c": 15_000}
    sources = counted.groupBy("source").agg({"n_tokens": "sum"}).toDF("source", "tokens")
    step = mixing.find_exponent(sources, 80_000, target_entropy=0.95, max_repeats=2.0)
    power = {s: (n / 80_000) ** (step / mixing.STEPS) for s, n in tokens.items()}
    longest = {"big": 40_000, "b": 100, "c": 100}
    for source, q in power.items():
        quota = math.floor(q / sum(power.values()) * 80_000 + 0.5)
        assert quota <= taken[source] < quota + longest[source]
