"""Quality rules: a decision list learned from labelled statistics, run as Spark conditions.

The statistics are DataFrame expressions. Sequential covering learns the list: a
rule, a conjunction of thresholds, grows by information gain on two thirds of the
labelled rows, is cut back on the other third, and the rows it covers are set
aside before the next one. The list is emitted as one ordered conditional
expression, so judging a document is part of the scan's own stage.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import words

SYMBOLS = "#*$%&|<>"
#: The statistics that rules may test, all relative to the text's own length.
FEATURES = (
    "n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate",
    "digit_rate", "distinct_rate", "stop_rate", "mean_line", "mark_rate",
)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and FEATURES.

    A null text has no words. Each document is handled inside its row: repeated
    three-word windows are found by sorting the windows' hashes, O(n log n) for any
    length. No shuffle.
    """
    text = words.text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), words.words(text).alias("w"))
    n = F.size("w")
    hashes = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(
                F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    rows = rows.withColumn("s", F.sort_array(hashes))

    def same(e: Column, k: Column) -> Column:
        return F.coalesce(F.get("s", k)["h"] == e["h"], F.lit(False))

    repeated = F.filter("s", lambda e, k: same(e, k - 1) | same(e, k + 1))
    rows = rows.withColumn("p", F.sort_array(F.transform(repeated, lambda e: e["i"])))
    covered = F.aggregate(
        F.transform("p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("p", k + 1), x + 3) - x)),
        F.lit(0),
        lambda a, x: a + x,
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, words.WHITE, "") != F.lit(""))

    def without(chars: str) -> Column:
        return F.length("text") - F.length(F.translate("text", chars, ""))

    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        (F.length("text") - without(words.WHITE)).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("d")).alias("lines"),
        covered.cast("long").alias("n_repeat_words"),
        without(words.UPPER).alias("upper"),
        without("0123456789").alias("digits"),
        without("!?.,;:").alias("marks"),
        F.size(F.array_distinct("w")).alias("distinct"),
        F.size(F.filter("w", lambda x: F.length(x) <= 3)).alias("short"),
    )
    per_word = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    per_char = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    per_line = F.greatest(F.col("lines.n"), F.lit(1)).cast("double")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (F.col("word_chars") / per_word).alias("mean_word"),
        (F.col("n_symbols") / per_char).alias("symbol_rate"),
        ((F.col("lines.n") - F.col("lines.d")) / per_line).alias("dup_line_rate"),
        (F.col("n_repeat_words") / per_word).alias("repeat_rate"),
        (F.col("upper") / per_char).alias("upper_rate"),
        (F.col("digits") / per_char).alias("digit_rate"),
        (F.col("distinct") / per_word).alias("distinct_rate"),
        (F.col("short") / per_word).alias("stop_rate"),
        (F.col("n_words") / per_line).alias("mean_line"),
        (F.col("marks") / per_word).alias("mark_rate"),
    )


@dataclass(frozen=True)
class Condition:
    """A threshold on one statistic; ``at_least`` gives its direction."""

    feature: str
    at_least: bool
    threshold: float

    def compare(self, value):
        return (operator.ge if self.at_least else operator.le)(value, self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """Documents that meet all conditions are rejected."""

    conditions: tuple[Condition, ...]

    def covers(self, x: np.ndarray) -> np.ndarray:
        met = np.ones(len(x), dtype=bool)
        for c in self.conditions:
            met &= c.compare(x[:, FEATURES.index(c.feature)])
        return met

    def column(self) -> Column:
        met = F.lit(True)
        for c in self.conditions:
            met = met & c.compare(F.col(c.feature))
        return met

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one expression: false for the first rule met, else true."""
    if not rules:
        return F.lit(True)
    chain = F
    for rule in rules:
        chain = chain.when(rule.column(), F.lit(False))
    return chain.otherwise(F.lit(True))


def grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray], most: int) -> list[Condition]:
    """Adds the condition of the highest information gain until no good row is covered."""
    conditions: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while len(conditions) < most:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if p == 0 or n == 0:
            break
        base, best = np.log2(p / (p + n)), (1e-9, None)
        for j, name in enumerate(FEATURES):
            values, flags = x[inside, j], bad[inside]
            order = np.argsort(values, kind="stable")
            values, hits = values[order], np.concatenate([[0], np.cumsum(flags[order])])
            for at_least, side in ((True, "left"), (False, "right")):
                edge = np.searchsorted(values, cuts[j], side=side)
                covered = len(values) - edge if at_least else edge
                pos = p - hits[edge] if at_least else hits[edge]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / covered) - base), -np.inf)
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best[0]:
                    best = (float(gain[k]), Condition(name, at_least, float(cuts[j][k])))
        if best[1] is None:
            break
        conditions.append(best[1])
        inside &= best[1].compare(x[:, FEATURES.index(best[1].feature)])
    return conditions


def prune(conditions: list[Condition], x: np.ndarray, bad: np.ndarray) -> Rule:
    """The beginning of the rule that is worth most on rows it was not grown on."""

    def worth(rule: Rule) -> float:
        met = rule.covers(x)
        p, n = int((met & bad).sum()), int((met & ~bad).sum())
        return (p - n) / (p + n + 1)

    tried = [Rule(tuple(conditions[:k])) for k in range(1, len(conditions) + 1)]
    return max(tried, key=lambda r: (worth(r), -len(r.conditions)))


def learn_rules(
    x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
    least_precision: float = 0.8, least_rows: int = 4, n_cuts: int = 200,
) -> list[Rule]:
    """Sequential covering over rows in a fixed order; the same rows give the same list."""
    left = np.ones(len(x), dtype=bool)
    third = np.arange(len(x)) % 3 == 2
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_cuts))) for j in range(x.shape[1])] if len(x) else []
    rules: list[Rule] = []
    while len(rules) < max_rules and (left & bad).sum() >= least_rows:
        growing, pruning = left & ~third, left & third
        conditions = grow(x[growing], bad[growing], cuts, max_conditions)
        if not conditions:
            break
        rule = prune(conditions, x[pruning], bad[pruning])
        met = rule.covers(x) & left
        if met.sum() < least_rows or (met & bad).sum() < least_precision * met.sum():
            break
        rules.append(rule)
        left &= ~met
    return rules


def learn(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality",
) -> list[Rule]:
    """A decision list from the labelled rows that are not held out.

    About ``max_labelled`` of them are used, chosen by a hash of the id; this bounds the
    broadcast list of ids and the rows of numbers that reach the driver. Without
    labels of both kinds the list is empty and keeps everything.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & ~words.held_out(F.col(id_col)))
    chosen = chosen.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    share = int(1_000_000 * min(1.0, max_labelled / max(chosen.count(), 1)))
    picked = chosen.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "id"
    )
    rated = text_statistics(sample.select(F.struct("id", "label").alias("key"), "text"), "key")
    rows = rated.select("doc_id.*", *FEATURES).collect()
    rows.sort(key=lambda r: (hash(int(r.id) * 2654435761 % 2**32), tuple(r)))
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows]).reshape(len(rows), len(FEATURES))
    return learn_rules(x, np.array([r.label == 0 for r in rows], dtype=bool))


def judge_documents(
    docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, kept.

    Null and empty texts have no words and fail the base; repeated rows and null ids
    stay; further columns are left behind.
    """
    rated = text_statistics(docs, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )
