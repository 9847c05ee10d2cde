from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from fabpulse.llm import byte_bpe, language_id, mixing, quality_rules, simhash

LANGUAGES = {"en": "the and of that with from this thing ring sheep long tree river",
             "de": "der und von dass mit für über schön straße ich weg baum fluss"}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean texts, symbol junk, near copies, texts without letters, and hard rows."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(150):
        lang = sorted(LANGUAGES)[i % 2]
        words = [rng.choice(LANGUAGES[lang].split()) + rng.choice(["", "s", "n", "ing"])
                 for _ in range(rng.randint(60, 90))]
        if i % 5 == 4:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), lang, f"src{i % 4}", 1))
        labels.append((i, int(i % 5 != 4), 0))
    rows += [(200, rows[0][1], "en", "src0", 1), (201, rows[0][1].upper(), "en", "src1", 1),
             (202, "1234 5678 " * 60, "en", "src1", 1), (203, None, None, None, None),
             (204, "", "en", "src2", 0), (3, rows[3][1], "de", "src3", 1)]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def test_stages_one_by_one(llm, corpus, tmp_path):
    folder, rows = corpus
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(llm, kept[-1], folder).write.parquet(f"{tmp_path}/{name}")
        kept.append(llm.read.parquet(f"{tmp_path}/{name}"))
        assert kept[-1].columns == docs.columns
    spoken, good, single, mixed = ([tuple(r) for r in df.collect()] for df in kept[1:])

    model = language_id.fit(docs)
    assert sorted(spoken) == sorted(r for r in rows if not model.predict(r[1])[2])
    assert not {202, 203, 204} & {r[0] for r in spoken}

    assert {r[0] for r in good} == {r[0] for r in spoken if not r[1].count("#")}

    groups = {}
    for row in sorted(good):
        near = [g for g in groups if (g ^ simhash.fingerprint(row[1])).bit_count() <= 2]
        groups.setdefault(near[0] if near else simhash.fingerprint(row[1]), row)
    assert sorted(single) == sorted(groups.values())
    assert not {200, 201} & {r[0] for r in single}

    counted = mixing.mix(mixing.countable(kept[3]))
    assert Counter(r[0] for r in mixed) == Counter(r.doc_id for r in counted.collect())

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks=byte_bpe.Merges(ranks).ranks)
    final = corpus_pipeline.run(llm, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in final) == Counter(
        (r[0], len(encoding.encode_ordinary(r[1])), hashlib.sha256(r[1].encode()).hexdigest())
        for r in mixed)


def test_empty_documents(llm, corpus, tmp_path):
    folder, _ = corpus
    empty = llm.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(llm, empty, folder).count() == 0


def test_judging_equals_learning(llm, corpus):
    """The rules of the fixture tell all junk from all clean documents."""
    folder, rows = corpus
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    rules = quality_rules.fit(docs, llm.read.parquet(f"{folder}/labels.parquet"))
    judged = {r.doc_id: r.kept for r in quality_rules.judge(docs, rules).collect()}
    assert all(judged[i] == (i % 5 != 4) for i in range(150))
