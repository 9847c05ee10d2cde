"""Quality rules: decision lists learned from labelled statistics of texts.

Every text gets a few counts (`with_statistics`). From a bounded sample of labelled documents,
sequential covering learns an ordered list of rules, each a conjunction of thresholds on ratios
of these counts that tells bad documents. A rule is grown on two thirds of the sample by
information gain, pruned on the rest, and kept while it is precise there. The list becomes one
Spark conditional expression, so applying it costs nothing beside the counting.

Defined results: a null or empty text has no words and all counts zero. Repeated rows are judged
one by one. Labels that are null, or given twice with different values, are not learned from; with no
usable labels of both kinds the list is empty and only the base rules decide.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabpulse.llm.words import SYMBOLS, WHITE, words

UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
LINE_END = b"!?."

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks")
STATISTICS = "struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">"

# Base rules, fixed: the fewest words, and the largest share of repeated words in percent.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Ratios the rules may use: numerator and denominator.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def repeated_words(tokens: Sequence[bytes], width: int = 3) -> int:
    """Words in windows of `width` words that occur twice or more, the first included."""
    if len(tokens) <= width:
        return 0
    windows = list(zip(*(tokens[i:] for i in range(width))))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    marks = bytearray(len(tokens))
    for at, window in enumerate(windows):
        if times[window] > 1:
            marks[at:at + width] = b"\x01" * width
    return sum(marks)


def text_counts(text: str | None) -> tuple[int, ...]:
    """The values of COUNTS for one whole text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    tokens = words(text)

    def how_many(characters: bytes) -> int:
        return len(raw) - len(raw.translate(None, characters))

    lines = [line for line in raw.split(b"\n") if line and line.strip(WHITE)]
    return (
        len(tokens), len(text) - how_many(WHITE), how_many(SYMBOLS),
        len(lines) - len(set(lines)), repeated_words(tokens),
        len(lines), how_many(UPPER), how_many(DIGITS), how_many(LINE_END),
    )


def _statistics(texts: pa.Array) -> pa.Array:
    rows = [text_counts(text) for text in texts.to_pylist()]
    columns = zip(*rows) if rows else [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(COUNTS))


def with_statistics(docs: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """Add the counts of each whole text as a struct column."""
    counted = F.arrow_udf(_statistics, STATISTICS).asNondeterministic()
    return docs.withColumn(into, counted(F.col(text)))


def base_failed(statistics: str = "statistics") -> Column:
    count = F.col(statistics)
    return (count["n_words"] < MIN_WORDS) | (
        100 * count["n_repeat_words"] > MAX_REPEAT_PERCENT * count["n_words"])


@dataclass(frozen=True)
class Condition:
    """`ratio` is above (or at most, if not `above`) the threshold."""

    ratio: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.ratio]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self, statistics: str) -> Column:
        over, under = RATIOS[self.ratio]
        count = F.col(statistics)
        share = count[over].cast("double") / F.greatest(count[under], F.lit(1)).cast("double")
        return share > self.threshold if self.above else share <= self.threshold

    def __str__(self) -> str:
        return f"{self.ratio} {'>' if self.above else '<='} {self.threshold:.4g}"


Rule = tuple[Condition, ...]


def ratios(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {name: counts[over].astype(float) / np.maximum(counts[under], 1)
            for name, (over, under) in RATIOS.items()}


def _covers(rule: Rule, values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    hit = among.copy()
    for condition in rule:
        hit &= condition.holds(values)
    return hit


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray,
          max_conditions: int) -> Rule:
    """Add the condition of largest information gain until no good document is covered."""
    rule: Rule = ()
    hit = among.copy()
    while len(rule) < max_conditions and (hit & ~bad).any():
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        best, best_gain = None, 1e-9
        for ratio, column in values.items():
            inside = np.unique(column[hit])
            if len(inside) < 2:
                continue
            cuts = (inside[1:] + inside[:-1]) / 2
            cuts = np.unique(np.quantile(cuts, np.linspace(0, 1, min(64, len(cuts)))))
            bads, goods = np.sort(column[hit & bad]), np.sort(column[hit & ~bad])
            below_p = np.searchsorted(bads, cuts, "right")
            below_n = np.searchsorted(goods, cuts, "right")
            for above, p1, n1 in ((True, p - below_p, n - below_n), (False, below_p, below_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p1 > 0, p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n))), 0)
                at = int(np.argmax(gain))
                if gain[at] > best_gain:
                    best, best_gain = Condition(ratio, above, float(cuts[at])), gain[at]
        if best is None:
            break
        rule += (best,)
        hit &= best.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray) -> Rule:
    """The shortest beginning of the rule with the best (p - n) / (p + n)."""
    def worth(part: Rule) -> float:
        hit = _covers(part, values, among)
        return ((hit & bad).sum() - (hit & ~bad).sum()) / max(1, hit.sum())

    return max((rule[:n] for n in range(1, len(rule) + 1)), key=worth)


def learn_rules(counts: dict[str, np.ndarray], bad: np.ndarray, *, min_precision: float = 0.95,
                min_covered: int = 5, max_rules: int = 24, max_conditions: int = 4) -> list[Rule]:
    """Sequential covering over labelled statistics; rows are taken in the order given."""
    values = ratios(counts)
    held = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules and (left & ~held & bad).any():
        rule = _grow(values, bad, left & ~held, max_conditions)
        if not rule:
            break
        rule = _prune(rule, values, bad, left & held)
        hit = _covers(rule, values, left)
        precision = min(bad[part].mean() if part.any() else 1.0
                        for part in (hit & held, hit & ~held))
        if hit.sum() < min_covered or precision < min_precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def rule_number(rules: Sequence[Rule], statistics: str = "statistics") -> Column:
    """The first rule (from 1) that a document meets, 0 if none."""
    chain = None
    for number, rule in enumerate(rules, 1):
        met = F.lit(True)
        for condition in rule:
            met = met & condition.column(statistics)
        chain = F.when(met, number) if chain is None else chain.when(met, number)
    return F.lit(0) if chain is None else chain.otherwise(0)


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = 12_000, **how) -> list[Rule]:
    """Learn from at most `sample` labelled documents, chosen by a hash of their id.

    `docs` has doc_id and text, `labels` has doc_id and quality (1 good, 0 bad).
    """
    spark = docs.sparkSession
    chosen = (
        labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_high"))
        .where("quality = _high").select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # At most `sample` pairs of numbers, so the broadcast is bounded.
    known = spark.createDataFrame(chosen.toArrow())
    labelled = (
        with_statistics(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"))
        .select("doc_id", "quality", "statistics.*")
        .orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample)
    ).toArrow()
    bad = labelled["quality"].to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    return learn_rules({name: labelled[name].to_numpy() for name in COUNTS}, bad, **how)


def judge(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Add `statistics`, `base_failed`, `rule` and `kept` to documents."""
    return (
        with_statistics(docs, text)
        .withColumn("base_failed", base_failed())
        .withColumn("rule", rule_number(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )
