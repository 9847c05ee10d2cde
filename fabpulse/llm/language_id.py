"""Language identification by averaged subword embeddings.

Subwords are the 2- to 4-letter runs of lower-cased words, with their edges marked, hashed to a
fixed number of buckets. A text is the mean of its subwords' embeddings, and a linear softmax on
it gives the language. Both are trained together by stochastic gradient descent in numpy on a
bounded sample. As mean and softmax weights are linear, their product, one row per bucket and one column
per language, is all a prediction needs. Scores are calibrated by a temperature, and the rejection
threshold is read off the scores of sample documents that were not trained on.

Defined results: a null text, or one without a letter, is `und` with score 0 and rejected. Very
long texts are read in slices that overlap, so that no subword is lost or added. Without any labelled text every
document is `und`. Repeated rows are predicted one by one.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
SLICE = 1 << 19  # letters read at a time

# Constants of the subword hash.
_STEP, _MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)),
                       bool, 0x110000)


def subword_slices(text: str, buckets: int):
    """The buckets of all subwords of a whole text, slice by slice; nothing without a letter."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    lowered = text.lower()
    for start in range(0, len(lowered) + 1, SLICE):
        # Subwords that begin here, counting from the edge before the text; they reach three letters on.
        piece = lowered[max(0, start - 1):start + SLICE + 2].encode("utf-32-le")
        points = np.frombuffer(piece, np.uint32)
        letter = _letters()[points]
        if not letter.any():
            continue
        edged = min(SLICE + 3, len(lowered) + 2 - start)
        codes, inner = np.zeros(edged, np.uint32), np.zeros(edged, bool)
        own = slice(int(start == 0), int(start == 0) + len(points))
        inner[own] = letter
        codes[own] = np.where(letter, points, np.uint32(0))
        pairs = codes[:-1] * _STEP + codes[1:]
        triples = pairs[:-1] * _STEP + codes[2:]
        fours = triples[:-1] * _STEP + codes[3:]
        middle = inner[1:-2] & inner[2:-1]
        found = np.concatenate((
            pairs[:SLICE][(inner[:-1] | inner[1:])[:SLICE]], triples[:SLICE][inner[1:-1][:SLICE]],
            fours[:SLICE][middle[:SLICE]]))
        yield (found * _MIX) >> shift


def bucket_counts(text: str | None, buckets: int) -> np.ndarray:
    counts = np.zeros(buckets, np.int64)
    for found in subword_slices(text or "", buckets):
        counts += np.bincount(found, minlength=buckets)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    """`weights` has a row per bucket and a column per language."""

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        """From the mean bucket frequencies of texts, a row each."""
        return softmax((means @ self.weights + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the score is too low to believe."""
        counts = bucket_counts(text, len(self.weights))
        total = counts.sum()
        if not total or not self.languages:
            return UNDETERMINED, 0.0, True
        chance = self.probabilities((counts / total)[None])[0]
        best = int(np.argmax(chance))
        return self.languages[best], float(chance[best]), bool(chance[best] < self.threshold)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, languages: tuple[str, ...],
          buckets: int, *, dimensions: int = 16, epochs: int = 12, rate: float = 8.0,
          batch: int = 32, reject: float = 0.002, seed: int = 7) -> LanguageModel:
    """Train on four fifths of the rows (bucket, count), calibrate on the others."""
    n, k = len(rows), len(languages)

    def means(which: np.ndarray) -> np.ndarray:
        out = np.zeros((len(which), buckets), np.float32)
        for at, row in enumerate(which):
            index, count = rows[row]
            out[at, index] = count / max(1, count.sum())
        return out

    random = np.random.default_rng(seed)
    held = np.arange(n) % 5 == 4 if n >= 50 else np.zeros(n, bool)
    learn, check = np.flatnonzero(~held), np.flatnonzero(held if held.any() else ~held)
    share = np.bincount(target[learn], minlength=k)
    weight = (len(learn) / np.maximum(1, share) / k)[target].astype(np.float32)
    embedding = (random.standard_normal((buckets, dimensions)) / dimensions).astype(np.float32)
    head = np.zeros((dimensions, k), np.float32)
    bias = np.zeros(k, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(random.permutation(learn), max(1, len(learn) // batch)):
            x = means(part)
            hidden = x @ embedding
            wrong = softmax(hidden @ head + bias)
            wrong[np.arange(len(part)), target[part]] -= 1
            wrong *= weight[part, None] / len(part)
            back = wrong @ head.T
            head -= step * (hidden.T @ wrong)
            bias -= 0.01 * step * wrong.sum(axis=0)
            used = np.flatnonzero(x.any(axis=0))
            # A bucket is a small share of a text, and so of its gradient.
            embedding[used] -= step * 50 * (x[:, used].T @ back)
    weights = (embedding @ head).astype(np.float64)
    logits = np.concatenate([means(part) @ weights + bias
                             for part in np.array_split(check, max(1, len(check) // 256))])
    loss = {t: -np.log(softmax(logits / t)[np.arange(len(check)), target[check]] + 1e-12).mean()
            for t in np.geomspace(0.05, 20, 41)}
    temperature = float(min(loss, key=loss.get))
    right = logits.argmax(axis=1) == target[check]
    sure = softmax(logits / temperature).max(axis=1)
    # Of what is predicted rightly, the share `reject` at most is rejected.
    threshold = float(np.quantile(sure[right], reject)) if right.any() else 1.0
    return LanguageModel(languages, weights, bias.astype(np.float64), temperature, threshold)


def _counts_udf(buckets: int):
    @F.arrow_udf("struct<bucket:array<int>,count:array<int>>")
    def counts(texts: pa.Array) -> pa.Array:
        found = [bucket_counts(text, buckets) for text in texts.to_pylist()]
        index = [np.flatnonzero(row) for row in found]
        return pa.StructArray.from_arrays(
            [pa.array([i.astype(np.int32) for i in index], pa.list_(pa.int32())),
             pa.array([row[i].astype(np.int32) for row, i in zip(found, index)],
                      pa.list_(pa.int32()))], ["bucket", "count"])

    return counts.asNondeterministic()


def held_out(doc_id: str = "doc_id"):
    """Documents that must not be learned from, by their id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _slices(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column, as views of its values."""
    lists = column.combine_chunks()
    values = lists.flatten().to_numpy()
    ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
    return np.split(values, ends[:-1]) if len(ends) else []


def fit(docs: DataFrame, *, per_language: int = 1_000, max_languages: int = 256,
        buckets: int = 1 << 13, **how) -> LanguageModel:
    """Learn from about `per_language` labelled documents of each language, chosen by a hash.

    Takes the `max_languages` most frequent languages and twice the expected number of rows at
    most, so the sample that comes to the driver is bounded. Documents with a null id are left out.
    """
    usable = (
        docs.where("doc_id is not null and text is not null and lang is not null")
        .where(~held_out()).select("doc_id", "lang", "text")
    )
    sizes = (usable.groupBy("lang").count()
             .orderBy(F.desc("count"), "lang").limit(max_languages).collect())
    languages = tuple(sorted(row["lang"] for row in sizes))
    if not languages:
        return LanguageModel((), np.zeros((buckets, 0)), np.zeros(0), 1.0, 1.0)
    scale = 1 << 30
    share = F.create_map(*(F.lit(value) for row in sizes for value in
                           (row["lang"], int(scale * min(1, per_language / row["count"])))))
    drawn = (
        usable.withColumn("_draw", F.xxhash64("doc_id"))
        .where(F.pmod("_draw", F.lit(scale)) < share[F.col("lang")])
        .orderBy("_draw", "doc_id", "lang", F.xxhash64("text"))
        .limit(2 * per_language * len(languages))
    )
    sample = (drawn.select("lang", _counts_udf(buckets)("text").alias("found"))
              .select("lang", "found.*").toArrow())
    rows = list(zip(_slices(sample["bucket"]), _slices(sample["count"])))
    number = {language: at for at, language in enumerate(languages)}
    target = np.array([number[x] for x in sample["lang"].to_pylist()])
    full = [at for at, (index, _) in enumerate(rows) if len(index)]
    if not full:
        return LanguageModel((), np.zeros((buckets, 0)), np.zeros(0), 1.0, 1.0)
    return train([rows[at] for at in full], target[full], languages, buckets, **how)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text",
             into: str = "language") -> DataFrame:
    """Add a struct of `lang_pred`, `score` and `rejected` for each whole text."""
    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predicted(texts: pa.Array) -> pa.Array:
        found = [model.predict(value) for value in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([row[i] for row in found], kind) for i, kind in
             enumerate((pa.string(), pa.float64(), pa.bool_()))],
            ["lang_pred", "score", "rejected"])

    return docs.withColumn(into, predicted.asNondeterministic()(F.col(text)))
