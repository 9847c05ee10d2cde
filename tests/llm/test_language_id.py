from __future__ import annotations

import zlib

import numpy as np

from fabpulse.llm import language_id as lid

WORDS = {"en": "the and of that with from this thing ring sheep",
         "de": "der und von dass mit für über schön straße ich",
         "fr": "le et que avec pour où été français chien leçon"}


def texts(n, seed=0):
    random = np.random.default_rng(seed)
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        yield i, " ".join(random.choice(WORDS[lang].split(), 12)), lang


def test_learns_predicts_and_rejects(documents):
    docs = documents(*texts(240), (1_000, None, "en"), (1_001, "12 34 !", "de"), (None, "the and of"),
                     (1_002, "the and that of " * 200_000), (1_003, "Ελληνικά κείμενα"))
    model = lid.fit(docs, per_language=60)
    assert model.languages == ("de", "en", "fr")
    rows = {r.doc_id: r for r in lid.identify(docs, model).withColumn("held_out", lid.held_out())
            .select("doc_id", "lang", "language.*", "held_out").collect()}
    held = [r for i, r in rows.items() if i is not None and i < 240 and r.held_out]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())
    for i in (1_000, 1_001):
        assert (rows[i].lang_pred, rows[i].score, rows[i].rejected) == ("und", 0.0, True)
    assert rows[1_002].lang_pred == "en"
    assert rows[1_003].rejected
    assert rows[None].lang_pred == "en" and rows[None].held_out is False
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
               for i, r in rows.items() if i is not None)


def test_held_out_rows_do_not_matter(documents):
    rows = list(texts(90))
    spoiled = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    a, b = (lid.fit(documents(*given), per_language=40) for given in (rows, spoiled))
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_without_labels_everything_is_undetermined(documents):
    for docs in (documents((1, "some text")), documents((1, "x", "en")).limit(0)):
        model = lid.fit(docs)
        assert model.languages == ()
        assert [r.language.lang_pred for r in lid.identify(docs, model).collect()] in ([], ["und"])


def test_slices_of_long_texts_add_up(monkeypatch):
    random = np.random.default_rng(2)
    for letters in ("ab c", "abcdefgh", " ,.x", "aΣİ ς"):
        for n in (0, 1, 2, 6, 7, 8, 14, 100):
            text = "".join(random.choice(list(letters), n))
            with monkeypatch.context() as patch:
                whole = lid.bucket_counts(text, 64)
                patch.setattr(lid, "SLICE", 7)
                assert np.array_equal(lid.bucket_counts(text, 64), whole)
    assert lid.bucket_counts("ab", 64).sum() == 3 + 2 + 1  # pairs _a ab b_, triples, whole
    text = "x" * (lid.SLICE + 5)
    assert lid.bucket_counts(text, 64).sum() == 3 * len(text)
