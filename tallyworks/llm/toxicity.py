"""Toxicity: a weighted lexicon, found by Aho-Corasick after folding look-alikes.

Texts are folded (case, Cyrillic and Greek look-alikes, full-width forms,
zero-width characters, digits and signs standing for letters), the automaton
finds lexicon entries at word starts, exception phrases cancel the entries they
cover, and the summed weight is normalised by the number of words.

The lexicon is learned from labelled rows: an entry is a folded word or the
beginning of one, its weight a smoothed log-odds ratio over documents. Exception
phrases are two-word contexts in which an entry stands in clean documents only.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import lean, words
from tallyworks.session import pin

# Characters that look like Latin letters, and the letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
# Digits and signs written for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}

INVISIBLE = re.compile("[­​-‏⁠﻿]")
FOLD = str.maketrans(LOOK_ALIKES)
LETTER_DIGITS = re.compile(r"[013-578]*[^\W\d_][\w@$!|]*")
SIGN_BEFORE_LETTER = re.compile(r"[@$!|](?=[^\W\d_])")
HAS_SIGN = re.compile(r"[@$!|013-578]")
ANY_SIGN = re.compile(r"[@$!|]")
SIGNS_AT_END = re.compile(r"([^\W\d_]+)([@$!|]+)(?![\w@$!|])")
LETTERS = str.maketrans(DIGITS | SIGNS)
TERM = re.compile(r"[^\W\d_]+")
PREFIXES = range(4, 11)


def fold(text: str) -> str:
    """Lower case with look-alikes, invisible characters and substitutions undone.

    Inside a word digits and signs stand for letters alike; signs at its end stay.
    """
    if not text.isascii():
        text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    text = text.lower()
    if not text.isascii():
        text = text.translate(FOLD)
    if HAS_SIGN.search(text):
        text = SIGN_BEFORE_LETTER.sub(lambda m: SIGNS[m[0]], text)
        text = LETTER_DIGITS.sub(_inner_letters, text)
    return text


def _inner_letters(m: re.Match) -> str:
    word = m[0]
    if not HAS_SIGN.search(word):
        return word
    body = word.rstrip("@$!|")
    return body.translate(LETTERS) + word[len(body) :]


@dataclass(frozen=True)
class Lexicon:
    """Weights of entries; an entry ending in a blank is a whole word, else a beginning.

    ``bias`` and ``slopes`` turn the summed weight and its share into a score.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    bias: float = -2.0
    slopes: tuple[float, float] = (1.0, 1.0)
    _made: dict = field(default_factory=dict, compare=False, repr=False)

    def __reduce__(self):
        return Lexicon, (self.weights, self.exceptions, self.bias, self.slopes)

    def automaton(self):
        if "a" not in self._made:
            found = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                # The blank in front anchors an entry at a word start.
                found.add_word(f" {entry}", (len(entry), weight))
            for phrase in self.exceptions:
                found.add_word(f" {phrase} ", (len(phrase), None))
            found.make_automaton()
            self._made["a"] = found
        return self._made["a"]

    def knows(self, word: str) -> bool:
        """Whether the word or one of its beginnings is an entry."""
        return f"{word} " in self.weights or any(word[:n] in self.weights for n in PREFIXES if n <= len(word))

    def _with_signs(self, m: re.Match) -> str:
        """A word with signs at its end: as letters if only then it is an entry."""
        whole = m[0].translate(LETTERS)
        return whole if self.knows(whole) and not self.knows(m[1]) else m[0]

    def hits(self, text: str) -> tuple[dict[int, tuple[float, int]], str, int]:
        """Weight and length of the heaviest entry by position, the word string, words."""
        folded = fold(text)
        if self.weights and ANY_SIGN.search(folded):
            folded = SIGNS_AT_END.sub(self._with_signs, folded)
        terms = TERM.findall(folded)
        line = f" {' '.join(terms)} "
        best: dict[int, tuple[float, int]] = {}
        covered: list[tuple[int, int]] = []
        if not self.weights:
            return best, line, len(terms)
        for end, (length, weight) in self.automaton().iter(line):
            if weight is None:
                covered.append((end - length, end))
            else:
                start = end - length + 1
                if start not in best or best[start][0] < weight:
                    best[start] = (weight, length)
        for first, last in covered:
            for start in [s for s in best if first <= s < last]:
                del best[start]
        return best, line, len(terms)

    def features(self, text: str) -> tuple[float, float]:
        """The log of one plus the summed weight, and of one plus its share of the length."""
        best, _, n = self.hits(text)
        total = sum(weight for weight, _ in best.values())
        return float(np.log1p(total)), float(np.log1p(100 * total / (n + 10)))

    def score(self, text: str) -> float:
        a, b = self.features(text)
        return float(1 / (1 + np.exp(-(self.bias + self.slopes[0] * a + self.slopes[1] * b))))


def candidate_terms(text: str) -> set[str]:
    """Every folded word of at least three letters, and the beginnings of long ones."""
    terms = set()
    for word in set(TERM.findall(fold(text))):
        if len(word) >= 3:
            terms.add(f"{word} ")
            terms.update(word[:n] for n in PREFIXES if n <= len(word))
    return terms


def choose(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int, size: int) -> dict[str, float]:
    """The entries that explain most, without those an entry already taken covers."""

    def weight(pos: int, neg: int) -> float:
        return float(np.log((pos + 0.5) / (n_toxic + 1)) - np.log((neg + 0.5) / (n_clean + 1)))

    def gain(pos: int, neg: int) -> float:
        expected = max((pos + neg) * n_toxic / max(n_toxic + n_clean, 1), 1e-9)
        return pos * np.log(max(pos, 1e-9) / expected) - 2 * neg

    taken: dict[str, float] = {}
    seen_in: dict[str, int] = {}
    # Of entries that explain the same documents the longest is the safest.
    for term, pos, neg in sorted(counts, key=lambda c: (-gain(c[1], c[2]), -len(c[0]), c[0])):
        own = weight(pos, neg)
        if any(
            term.startswith(t) and taken[t] >= own - 1 or t.startswith(term) and pos <= 1.1 * seen_in[t]
            for t in taken
        ):
            continue
        taken[term], seen_in[term] = own, pos
        if len(taken) == size:
            break
    return taken


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, tuple[float, float]]:
    """Bias and slopes by Newton steps with a small ridge; the same result for the same rows."""
    design = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p) + 1e-9)[:, None]) + ridge
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), (float(beta[1]), float(beta[2]))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    size: int = 512,
    least_docs: int = 4,
    least_odds: float = 8.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Lexicon:
    """A lexicon from the labelled rows that are not held out.

    About ``max_labelled`` ids of them are used, chosen by a hash, so the broadcast list of
    ids has a bound. The entries are chosen from the ``20 * size`` candidates that are in
    most toxic and fewest clean texts, exception phrases are the ``size`` most frequent;
    besides, two numbers a row reach the driver. Null labels, ids and texts are left out; with no labelled row of one kind the lexicon is empty and every
    score is the share of toxic rows (0.5 without any).
    """
    chosen = labels.where(F.col(label_col).isNotNull() & ~words.held_out(F.col(id_col)))
    chosen = chosen.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    total = chosen.count()
    share = int(1_000_000 * min(1.0, max_labelled / max(total, 1)))
    picked = chosen.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.where("text IS NOT NULL").join(F.broadcast(picked), "id").select("text", "label")
    rows = pin(rows)
    n_all, n_toxic = rows.select(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if n_toxic in (0, n_all):
        return Lexicon({}, bias=float(np.log((n_toxic + 0.5) / (n_all - n_toxic + 0.5))))

    n_clean = n_all - n_toxic
    counted = (
        _counted(rows, candidate_terms)
        .groupBy("term")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") >= least_docs)
        .where((F.col("pos") + 0.5) * (n_clean + 1) > (F.col("neg") + 0.5) * (n_toxic + 1) * least_odds)
        .orderBy(F.desc(F.col("pos") - 2 * F.col("neg")), "term")
        .limit(20 * size)
    )
    weights = choose([tuple(r) for r in counted.collect()], n_toxic, n_clean, size)
    plain = Lexicon(weights)

    phrases = (
        _counted(rows, functools.partial(two_word_contexts, plain))
        .groupBy(F.col("term").alias("phrase"))
        .agg(F.sum("pos").alias("pos"), F.sum(F.col("pos") + F.col("neg")).alias("all"))
        .where((F.col("pos") == 0) & (F.col("all") >= least_docs))
        .orderBy(F.desc("all"), "phrase")
        .limit(size)
    )
    lexicon = Lexicon(weights, tuple(r.phrase for r in phrases.collect()))
    seen = rows.select(_features(F.col("text"), lexicon).alias("f"), "label").select("f.*", "label").collect()
    x = np.array([(r.a, r.b) for r in seen])
    bias, slopes = fit_logistic(x, np.array([r.label for r in seen], dtype=float))
    return Lexicon(lexicon.weights, lexicon.exceptions, bias, slopes)


def _counted(rows: DataFrame, terms_of: Callable[[str], set[str]]) -> DataFrame:
    """(term, pos, neg): in how many toxic and other texts of a slice of rows a term is."""

    @lean.released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in lean.sliced(batch):
                seen: tuple[Counter, Counter] = Counter(), Counter()
                for text, label in zip(some.column(0), some.column(1)):
                    seen[1 if label.as_py() else 0].update(terms_of(text.as_py()))
                terms = sorted(seen[0].keys() | seen[1].keys())
                numbers = ([seen[k][t] for t in terms] for k in (1, 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, type=pa.string()), *(pa.array(n, type=pa.int64()) for n in numbers)],
                    names=["term", "pos", "neg"],
                )

    return rows.select("text", "label").mapInArrow(count, "term string, pos long, neg long")


def two_word_contexts(lexicon: Lexicon, text: str) -> set[str]:
    best, line, _ = lexicon.hits(text)
    found = set()
    for start in best:
        # ``start`` is the first letter of a word in the blank-separated line.
        end = line.index(" ", start)
        if end + 1 < len(line):
            found.add(line[start : line.index(" ", end + 1)])
        if start > 1:
            found.add(line[line.rindex(" ", 0, start - 1) + 1 : end])
    return found


def _features(text: Column, lexicon: Lexicon) -> Column:
    @F.arrow_udf("struct<a: double, b: double>")
    @lean.released
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [lexicon.features(t.as_py() or "") for t in texts]
            yield pa.array([{"a": a, "b": b} for a, b in found], type=pa.struct([("a", pa.float64()), ("b", pa.float64())]))

    return features(text)


def toxicity(text: Column, lexicon: Lexicon) -> Column:
    """The score of a text column, 0 to 1; null counts as empty."""

    @F.arrow_udf("double")
    @lean.released
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array((lexicon.score(t.as_py() or "") for t in texts), type=pa.float64())

    return score(text)


def score_documents(
    docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, whether held out, score, predicted label.

    Null and empty texts get the score of a text without any entry; repeated rows
    and null ids stay (a null id is not held out); further columns are left
    behind. No shuffle.
    """
    scored = docs.select(
        F.col(id_col),
        F.coalesce(words.held_out(F.col(id_col)), F.lit(False)).alias("held_out"),
        toxicity(F.col(text_col), lexicon).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
