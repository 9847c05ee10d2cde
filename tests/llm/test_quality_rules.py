from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from fabpulse.llm import quality_rules as q


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated))


@given(st.text("ab \n\t \u0085é#|", max_size=60))
def test_counts_match_definitions(text):
    assert q.text_counts(text)[:5] == brute_counts(text)


def test_query_columns_and_hard_rows(documents):
    good = " ".join(f"word{i}" for i in range(60))
    docs = documents((1, good), (1, good), (2, None), (None, ""), (3, "spam ham jam " * 400_000),
                     (4, good + "\n" + "same line\n" * 3))
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.base_failed, r.kept, *r.statistics[:5])
                    for r in q.judge(docs, []).collect()))
    texts = {1: good, 2: None, 0: "", 3: "spam ham jam " * 400_000,
             4: good + "\n" + "same line\n" * 3}
    assert [row[1] for row in found] == [1, 1, 2, 3, 4, 0]
    for row in found:
        if row[1] != 3:
            assert row[4:] == brute_counts(texts[row[1]])
    assert [row[2] for row in found] == [False, False, True, True, False, True]
    assert all(row[3] != row[2] for row in found)


def made_counts(n, seed=1):
    random = np.random.default_rng(seed)
    counts = {name: random.integers(0, 5, n) for name in q.COUNTS}
    counts["n_words"] = random.integers(50, 500, n)
    counts["word_chars"] = counts["n_words"] * 5
    counts["n_lines"] = np.full(n, 10)
    return counts


def test_learns_a_planted_conjunction():
    counts = made_counts(900)
    counts["n_symbols"] = np.where(np.arange(900) % 2, 400, 0)
    counts["n_upper"] = np.where(np.arange(900) // 2 % 2, 1000, 0)
    bad = (np.arange(900) % 2 == 1) & (np.arange(900) // 2 % 2 == 1)
    rules = q.learn_rules(counts, bad)
    values = q.ratios(counts)
    caught = np.zeros(900, bool)
    for rule in rules:
        caught |= q._covers(rule, values, np.ones(900, bool))
    assert (caught == bad).all()
    assert "symbols_per_word" in " ".join(map(str, rules[0]))


def test_noise_is_not_learned():
    assert q.learn_rules(made_counts(300), np.random.default_rng(3).random(300) < 0.3) == []


@pytest.fixture
def labelled(documents, llm):
    text = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(120)]
    docs = documents(*((i, t.replace(" ", "### ") if i % 3 == 0 else t) for i, t in enumerate(text)))
    labels = llm.createDataFrame([(i, int(i % 3 != 0)) for i in range(120)]
                                 + [(5, 0), (7, None), (None, 0)], "doc_id long, quality int")
    return docs, labels


def test_fit_and_judge(labelled):
    docs, labels = labelled
    judged = q.judge(docs, q.fit(docs, labels)).collect()
    assert all(row.kept == (row.doc_id % 3 != 0) for row in judged)


def test_empty_tables(documents, llm):
    none = llm.createDataFrame([], "doc_id long, quality int")
    docs = documents((1, "a"))
    assert q.fit(docs, none) == []
    assert q.fit(docs.limit(0), none) == []
    assert q.judge(docs.limit(0), []).count() == 0
