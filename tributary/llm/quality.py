"""Quality rules: text statistics and a learned decision list over them.

The list is learned by sequential covering. A rule is a conjunction of thresholds: it grows by the
literal of most information gain until it covers no good document of the growing rows, is pruned on
rows held back, and is kept while it is precise there. Rows that a rule covers are removed before the
next. The list is emitted as one ordered conditional expression, so scoring stays in Spark's own
functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrays import settled, words_of

REPEAT = 8
#: Labelled rows that a list is learned from at most, literals of a rule, rules, precision asked of a
#: rule on held-back rows, candidate thresholds of a statistic.
SAMPLE, LITERALS, RULES, PRECISION, THRESHOLDS = 8_000, 4, 12, 0.95, 48

_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Ratios that rules may test, from the statistics.
FEATURES = {
    "words": "n_words", "mean_word": "word_chars / greatest(n_words, 1)", "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)", "stops": "n_stops / greatest(n_words, 1)", "distinct": "n_distinct / greatest(n_words, 1)",
}


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with a struct column ``quality_statistics``; null text counts as empty.

    Every array is a column of its own projection, so it is made once for each row.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    one = docs.select(row, text.alias("t")).select("row", "t", words_of(F.col("t")).alias("w"))
    lines = F.expr(r"filter(split(t, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')")
    hashes = F.expr(f"if(size(w) < {REPEAT}, array(), transform(sequence(1, size(w) - {REPEAT - 1}), i -> xxhash64(slice(w, i, {REPEAT}))))")
    two = one.select(
        "row", F.size("w").alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"), F.size(F.array_distinct("w")).alias("n_distinct"),
        _count("[#*$%&|<>]+").alias("n_symbols"), _count("[A-Z]+").alias("n_capitals"), _count("[.,;:!?]+").alias("n_stops"), lines.alias("l"), hashes.alias("h"),
    )
    # Windows that occur again, found side by side after sorting; only where there are any.
    three = two.withColumn(
        "s", F.expr("if(size(array_distinct(h)) = size(h), cast(array() as array<struct<h:bigint,i:int>>), sort_array(transform(h, (x, i) -> struct(x as h, i as i))))")
    )
    four = three.withColumn("p", F.expr("sort_array(transform(filter(s, (x, k) -> x.h <=> get(s, k - 1).h or x.h <=> get(s, k + 1).h), x -> x.i))"))
    covered = F.expr(f"aggregate(transform(p, (x, k) -> least({REPEAT}, coalesce(get(p, k + 1), x + {REPEAT}) - x)), 0, (a, x) -> a + x)")
    counted = four.select(
        "row", *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_capitals", "n_stops", "n_distinct")),
        F.size("l").cast("long").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"), covered.cast("long").alias("n_repeat_words"),
    )
    return counted.select("row.*", F.struct(*[c for c in counted.columns if c != "row"]).alias("quality_statistics"))


def _count(pattern: str) -> Column:
    """Characters of ``t`` in matches of the pattern."""
    return F.length("t") - F.length(F.regexp_replace("t", pattern, ""))


def base_failed(s: str = "quality_statistics") -> Column:
    """Too short, or mostly repetition."""
    return (F.col(f"{s}.n_words") < 20) | (100 * F.col(f"{s}.n_repeat_words") > 30 * F.col(f"{s}.n_words"))


def _features(s: str = "quality_statistics") -> dict[str, Column]:
    fields = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_stops", "n_distinct", "n_lines", "n_dup_lines", "n_repeat_words"]

    def of(formula: str) -> Column:
        for f in fields:
            formula = formula.replace(f, f"{s}.{f}")
        return F.expr(f"double({formula})")

    return {name: of(formula) for name, formula in FEATURES.items()}


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def on(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        column = x[:, names.index(self.feature)]
        return column >= self.threshold if self.above else column < self.threshold

    def column(self, features: dict[str, Column]) -> Column:
        c, t = features[self.feature], F.lit(float(self.threshold))
        return c >= t if self.above else c < t


Rule = tuple[Literal, ...]


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], seed: int = 7) -> list[Rule]:
    """Rules that reject, in order. Two thirds of the rows grow them, the rest prune and judge."""
    order = np.random.default_rng(seed).permutation(len(x))
    x, bad = x[order], bad[order]
    cut = 2 * len(x) // 3
    grow, prune = np.arange(len(x)) < cut, np.arange(len(x)) >= cut
    left, rules = np.ones(len(x), bool), []
    while len(rules) < RULES and (left & grow & bad).sum() >= 5:
        rule = _grow(x[left & grow], bad[left & grow], names)
        rule = _prune(rule, x[left & prune], bad[left & prune], names)
        hit = left & _covers(rule, x, names)
        right, wrong = (hit & prune & bad).sum(), (hit & prune & ~bad).sum()
        if not rule or right < 2 or right < PRECISION * (right + wrong) or (hit & bad).sum() < PRECISION * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for literal in rule:
        hit &= literal.on(x, names)
    return hit


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    rule: Rule = ()
    while len(rule) < LITERALS and len(bad) and not bad.all():
        before, best, gain = math.log2(bad.mean()) if bad.any() else 0, None, 1e-9
        for k, name in enumerate(names):
            cuts = np.unique(np.quantile(x[:, k], np.linspace(0, 1, THRESHOLDS + 1)))
            cuts = np.unique(np.concatenate([cuts, np.quantile(x[bad, k], np.linspace(0, 1, THRESHOLDS // 4 + 1))])) if bad.any() else cuts
            for above in (True, False):
                for t in cuts.tolist():
                    literal = Literal(name, above, t)
                    hit = literal.on(x, names)
                    right = (hit & bad).sum()
                    if right and (value := right * (math.log2(right / hit.sum()) - before)) > gain:
                        best, gain = literal, value
        if best is None:
            break
        hit = best.on(x, names)
        rule, x, bad = (*rule, best), x[hit], bad[hit]
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    """The beginning of the rule that is worth most on held-back rows; the longest of equals."""

    def worth(some: Rule) -> float:
        hit = _covers(some, x, names)
        right, wrong = (hit & bad).sum(), (hit & ~bad).sum()
        return (right - wrong) / (right + wrong) if right + wrong else -1

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def verdict(rules: list[Rule], features: dict[str, Column]) -> Column:
    """The list as an ordered conditional: false at the first rule that holds, else true."""
    keep = F.when(F.lit(False), F.lit(True))
    for rule in rules:
        holds = F.lit(True)
        for literal in rule:
            holds = holds & literal.column(features)
        keep = keep.when(holds, F.lit(False))
    return keep.otherwise(F.lit(True))


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """A list from at most ``sample`` labelled documents, those with the smallest hashed ids.

    Labels other than 0 and 1, labels without a document and documents without a label are left out.
    With few or no labels the list is empty and keeps everything.
    """
    picked = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id", "label").limit(sample)
    )
    source = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).alias("text"))
    # At most ``sample`` ids, so the broadcast is bounded.
    rows = with_statistics(source.join(F.broadcast(picked), "label_id"))
    names, features = list(FEATURES), _features()
    # Repeated ids must not lift the bound.
    table = rows.select(F.col("label").alias("label"), *[features[n].alias(n) for n in names]).limit(2 * sample).collect()
    data = np.array(sorted(tuple(float(v) for v in r) for r in table), dtype=float).reshape(-1, len(names) + 1)
    return learn(data[:, 1:], data[:, 0] == 0, names)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows with ``quality_statistics``, ``quality_base_failed`` and ``quality_kept``.

    Null and empty texts have statistics of zero and fail the base rule. Equal rows get equal
    verdicts; ids play no part.
    """
    scored = with_statistics(docs, text_col)
    failed = base_failed()
    return settled(scored.withColumns({"quality_base_failed": failed, "quality_kept": ~failed & verdict(rules, _features())}))
