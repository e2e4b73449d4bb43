"""LM scoring: masked pseudo-likelihood of every word given both of its sides.

A small network sees the two words before and the two after a place and predicts
the word there; a document's score is the sum over its words of the logarithm of
the probability they have. The output is a group of entries, then an entry of the
group. An entry is one of the corpus's most frequent words or a bucket of all other
words of one ending; a word of a bucket has the bucket's probability times its own
share of the bucket's words, from the counts of all words. The table of entries
grows with the corpus: every word that makes up at least the square root of all
words is predicted by itself.

Counts of the ``MOST_HOT`` most frequent words go to every task. The other words
are counted per document and meet the table of counts in a join; none of them can
be more than one in ``MOST_HOT`` of all words, so no key of that join is hot.

Training covers every document: rows are dealt by a hash of id and text into shares of
about ``SHARE`` words, in the order of that hash, so neither files nor splits matter. A
task starts from the same weights as all, takes gradient steps over its share, and gives
its weights with its number of words; Spark averages them, weight by weight. A first,
short round over one document in sixteen starts from random weights, the second over all
starts from its mean.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import lean
from tallyworks.session import pin

GROUPS = SIZE = 32  # at least so many entries: GROUPS x SIZE
ENDINGS = 256
REACH, WIDTH, HIDDEN = 2, 8, 16
PAD = GROUPS * SIZE
#: Words of a gradient step, and of the share of the corpus that one task trains on.
BLOCK = 8_192
SHARE = 4_000_000
#: Words whose counts every task holds, at most.
MOST_HOT = 200_000
#: Other words whose bucket a task remembers, at most.
REMEMBERED = 300_000
#: Words and characters a task counts before it hands its counts on.
COUNTED, READ = 300_000, 1 << 26
Shapes = dict[str, tuple[int, ...]]


def shapes(side: int) -> Shapes:
    """The weights of a network with ``side`` groups of ``side`` entries."""
    return {
        "embed": (side * side + 1, WIDTH),
        "hidden": (2 * REACH * WIDTH + 1, HIDDEN),
        "group": (HIDDEN + 1, side),
        "word": (side, HIDDEN + 1, side),
    }


def tokens_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


@dataclass
class Vocabulary:
    """Entries of words; those not ``known`` share the last ``ENDINGS`` entries by their ending.

    ``inside``: for the most frequent words the logarithm of their share of their entry.
    ``counts`` (word, n) has all words, ``totals`` the number of words in each bucket;
    these two stay at the driver.
    """

    known: dict[str, int]
    side: int = SIZE
    inside: dict[str, float] = field(default_factory=dict)
    counts: DataFrame | None = None
    totals: np.ndarray = field(default_factory=lambda: np.zeros(ENDINGS))
    n_words: int = 0
    seen: Codes | None = None

    def __reduce__(self):
        return Vocabulary, (self.known, self.side, self.inside)

    @property
    def pad(self) -> int:
        return self.side * self.side

    def numbers(self, line: list[str]) -> np.ndarray:
        """A number for every word: its place among the hot words, or below zero its bucket."""
        if self.seen is None:
            self.hot = sorted(self.known.keys() | self.inside.keys())
            self.seen = Codes((w, i) for i, w in enumerate(self.hot))
            self.seen.most = len(self.hot) + REMEMBERED
            other = self.pad - ENDINGS
            self.entry_of = np.array(
                [self.known[w] if w in self.known else other + bucket(w) for w in self.hot], dtype=np.int64
            )
            self.inside_of = np.array([self.inside.get(w, np.nan) for w in self.hot])
        return np.fromiter(map(self.seen.__getitem__, line), dtype=np.int64, count=len(line))

    def entries(self, codes: np.ndarray) -> np.ndarray:
        """The entry of each word, by its number."""
        found = self.pad - ENDINGS - 1 - codes
        hot = codes >= 0
        found[hot] = self.entry_of[codes[hot]]
        return found

    def shares(self, codes: np.ndarray) -> np.ndarray:
        """``inside`` of each word, by its number; NaN where it has none."""
        found = np.full(len(codes), np.nan)
        hot = codes >= 0
        found[hot] = self.inside_of[codes[hot]]
        return found


class Codes(dict):
    """Numbers of words; those of other words are made from their ending, some are remembered."""

    most = 0

    def __missing__(self, word: str) -> int:
        code = -1 - bucket(word)
        if len(word) <= 64 and len(self) < self.most:
            self[word] = code
        return code


def bucket(word: str) -> int:
    return zlib.crc32(word[-3:].encode()) % ENDINGS


def bucket_of(word: Column) -> Column:
    """``bucket`` as a column."""
    return (F.crc32(F.substring(word, -3, 3).cast("binary")) % ENDINGS).cast("int")


class Network:
    """The weights, their prediction and their gradient steps."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.side = len(weights["word"])
        self.tables: list[np.ndarray] = []
        self.squares = {k: np.full(v.shape, 1e-3, dtype=np.float32) for k, v in weights.items()}

    @classmethod
    def random(cls, seed: int = 11, side: int = SIZE) -> Network:
        rng = np.random.default_rng(seed)
        return cls({k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in shapes(side).items()})

    @classmethod
    def of_vector(cls, vector: np.ndarray, side: int = SIZE) -> Network:
        weights, at = {}, 0
        for name, shape in shapes(side).items():
            size = int(np.prod(shape))
            weights[name] = vector[at : at + size].reshape(shape).astype(np.float32)
            at += size
        return cls(weights)

    def vector(self) -> np.ndarray:
        return np.concatenate([self.w[name].ravel() for name in shapes(self.side)])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """The hidden layer and a one, for the entries around each place.

        Entries times their slice of the weights are made once a call for the whole table,
        so a place gathers and adds narrow rows.
        """
        h = np.ones((len(context), HIDDEN + 1), dtype=np.float32)
        total = np.broadcast_to(self.w["hidden"][-1], (len(context), HIDDEN)).copy()
        for d in range(2 * REACH):
            table = self.tables[d] if self.tables else self._table(d)
            total += table.take(context[:, d], axis=0)
        np.maximum(total, 0, out=h[:, :-1])
        return h

    def _table(self, d: int) -> np.ndarray:
        return self.w["embed"] @ self.w["hidden"][d * WIDTH : (d + 1) * WIDTH]

    def fixed(self) -> Network:
        """This network with its tables kept; its weights must not change any more."""
        self.tables = [self._table(d) for d in range(2 * REACH)]
        return self

    def _by_group(self, h: np.ndarray, group: np.ndarray):
        order = np.argsort(group.astype(np.int16), kind="stable")
        edges = np.searchsorted(group[order], np.arange(self.side + 1)).tolist()
        scores = np.empty((len(group), self.side), dtype=np.float32)
        sorted_h = h.take(order, axis=0)
        for g, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                np.matmul(sorted_h[a:b], self.w["word"][g], out=scores[a:b])
        return order, edges, sorted_h, scores

    def log_probability(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the entry at each place."""
        h = self.hidden(around(flat, at))
        group, place = np.divmod(flat[at], self.side)
        log_group = log_softmax(h @ self.w["group"], group)
        order, _, _, scores = self._by_group(h, group)
        log_group[order] += log_softmax(scores, place[order])
        return log_group

    def forward(self, flat: np.ndarray, at: np.ndarray):
        """Log-probability of the entry at each place, and what a gradient step needs."""
        context = around(flat, at)
        h = self.hidden(context)
        group, place = np.divmod(flat[at], self.side)
        p_group, log_group = softmax(h @ self.w["group"], group)
        order, edges, sorted_h, scores = self._by_group(h, group)
        place = place[order]
        p_word, log_sorted = softmax(scores, place)
        log_group[order] += log_sorted
        return log_group, (context, h, group, place, p_group, order, edges, sorted_h, p_word)

    def step(self, flat: np.ndarray, at: np.ndarray, rate: float) -> None:
        """One step of ascent on the mean log-probability of these places."""
        _, (context, h, group, place, p_group, order, edges, sorted_h, p_word) = self.forward(flat, at)
        n = len(at)
        rows = np.arange(n)
        # The gradients of the scores, less one at the entry that was there, with the sign turned.
        p_group[rows, group] -= 1
        p_word[rows, place] -= 1
        grads = {"group": -(h.T @ p_group), "word": np.zeros_like(self.w["word"])}
        d_h = p_group @ self.w["group"].T
        d_sorted = np.empty_like(sorted_h)
        for g, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                np.matmul(sorted_h[a:b].T, p_word[a:b], out=grads["word"][g])
                np.matmul(p_word[a:b], self.w["word"][g].T, out=d_sorted[a:b])
        np.negative(grads["word"], out=grads["word"])
        d_h[order] += d_sorted
        d_hidden = -d_h[:, :-1]
        d_hidden *= h[:, :-1] > 0
        # The sum of gradients by entry and side, then through the products of the tables.
        embed, hidden = np.zeros_like(self.w["embed"]), np.empty_like(self.w["hidden"])
        hidden[-1] = d_hidden.sum(axis=0)
        columns = np.ascontiguousarray(d_hidden.T)
        for d in range(2 * REACH):
            part = slice(d * WIDTH, (d + 1) * WIDTH)
            summed = np.stack(
                [np.bincount(context[:, d], weights=c, minlength=len(embed)) for c in columns], axis=1
            ).astype(np.float32)
            hidden[part] = self.w["embed"].T @ summed
            embed += summed @ self.w["hidden"][part].T
        grads |= {"hidden": hidden, "embed": embed}
        for name, g in grads.items():
            g /= n
            self.squares[name] += g * g
            self.w[name] += rate * g / np.sqrt(self.squares[name])


def around(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The entries beside each place, those before it first."""
    return np.stack([flat[at + d] for d in range(-REACH, REACH + 1) if d], axis=1)


def softmax(scores: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = exponentials(scores, target)
    total = scores.sum(axis=1)
    scores /= total[:, None]
    return scores, chosen - np.log(total)


def log_softmax(scores: np.ndarray, target: np.ndarray) -> np.ndarray:
    return exponentials(scores, target) - np.log(scores.sum(axis=1))


def exponentials(scores: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Makes scores their exponentials, and gives the score of the target before.

    float32 has room for scores up to 80 beside each other; only larger ones are shifted.
    """
    if len(scores) and (scores.max() > 60 or scores.min() < -60):
        scores -= scores.max(axis=1, keepdims=True)
    chosen = scores[np.arange(len(scores)), target]
    np.exp(scores, out=scores)
    return chosen


def laid_out(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries in one line with padding around each text, where they are, words per text."""
    line, counts = lined_up(texts)
    return padded(vocabulary.entries(vocabulary.numbers(line)), counts, vocabulary.pad)


def lined_up(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """All words one after the other, and the number of each text's."""
    line: list[str] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        tokens = tokens_of(text)
        counts[k] = len(tokens)
        line += tokens
    return line, counts


def padded(entries: np.ndarray, counts: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.full(len(entries) + 2 * REACH * (len(counts) + 1), pad, dtype=np.int64)
    starts = np.cumsum(counts + 2 * REACH) - counts
    at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(len(entries))
    flat[at] = entries
    return flat, at, counts


def padded_column(column: pa.ListArray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``padded`` for a column of entries."""
    ends = column.offsets.to_numpy()
    return padded(column.values.to_numpy()[ends[0] : ends[-1]], np.diff(ends).astype(np.int64), pad)


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of all words; counted in the tasks, by the same rule as when scoring."""

    @lean.released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        read = 0
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                counts.update(tokens_of(text))
                read += len(text or "")
                if len(counts) > COUNTED or read > READ:
                    yield told(counts)
                    counts, read = Counter(), 0
        if counts:
            yield told(counts)

    def told(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), type=pa.string()), pa.array(list(counts.values()), type=pa.int64())],
            names=["word", "n"],
        )

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def learn_vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    """Entries and shares from the counts of all words.

    What reaches the driver: how many words have each count (at most the square root
    of twice the number of words), ``MOST_HOT`` words and the ``ENDINGS`` totals.
    """
    counts = pin(count_words(docs, text_col))
    levels = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect()
    total = sum(r.n * r.words for r in levels)
    hot_from, hot, own = total + 1, 0, 0
    for r in levels:
        if hot + r.words > MOST_HOT:
            break
        hot_from, hot = r.n, hot + r.words
        if r.n * r.n >= total:
            own = hot
    top = counts.where(F.col("n") >= hot_from).collect()
    top.sort(key=lambda r: (-r.n, r.word))
    side = SIZE
    while side * side - ENDINGS < own:
        side += 8
    known = {r.word: i for i, r in enumerate(top[: side * side - ENDINGS])}
    totals = np.zeros(ENDINGS)
    for r in counts.groupBy(bucket_of(F.col("word")).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        totals[r.bucket] = r.n
    for r in top[: len(known)]:
        totals[bucket(r.word)] -= r.n
    inside = {r.word: 0.0 for r in top[: len(known)]}
    inside |= {r.word: float(np.log(r.n / totals[bucket(r.word)])) for r in top[len(known) :]}
    return Vocabulary(known, side, inside, counts, totals, total)


def coded_documents(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One stored row per row of ``docs``: ``row``, doc_id, ``h``, ``entries`` and shares of its words.

    ``h`` is a hash of id and text, ``inside`` the sum of what the vocabulary knows of the
    words' shares of their entries, ``rare`` and ``times`` the other words and how often
    they occur. Texts are split into words here once for training and scoring.
    """

    @lean.released
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in lean.sliced(batch):
                line, counts = lined_up(some.column(2).to_pylist())
                numbers = vocabulary.numbers(line)
                shares = vocabulary.shares(numbers)
                ends = np.concatenate([[0], np.cumsum(counts)])
                sums = np.concatenate([[0.0], np.cumsum(np.nan_to_num(shares))])[ends]
                # The words whose share of their bucket only the table of counts knows.
                rare = np.flatnonzero(np.isnan(shares))
                edges = np.searchsorted(rare, ends).tolist()
                others = [Counter(line[k] for k in rare[a:b].tolist()) for a, b in zip(edges, edges[1:])]
                entries = pa.ListArray.from_arrays(
                    pa.array(ends, type=pa.int32()), pa.array(vocabulary.entries(numbers), type=pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        some.column(1),
                        entries,
                        pa.array(np.diff(sums)),
                        pa.array([list(c) for c in others], type=pa.list_(pa.string())),
                        pa.array([list(c.values()) for c in others], type=pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "h", "entries", "inside", "rare", "times"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    chosen = docs.select(F.col(id_col), F.xxhash64(F.col(id_col), text), text)
    made = chosen.mapInArrow(
        code,
        f"doc_id {kind}, h long, entries array<int>, inside double, rare array<string>, times array<long>",
    )
    return pin(made.withColumn("row", F.monotonically_increasing_id()))


def train_round(entries: DataFrame, side: int, start: np.ndarray, rate: float) -> np.ndarray:
    """The mean, by number of words, of the weights of all tasks; ``start`` if there is no word."""

    @lean.released
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, trained = Network.of_vector(start, side), 0
        for batch in batches:
            for some in lean.sliced(batch, 500):
                flat, at, _ = padded_column(some.column(0), side * side)
                for a in range(0, len(at), BLOCK):
                    network.step(flat, at[a : a + BLOCK], rate)
                trained += len(at)
        if trained:
            vector = network.vector().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(vector), dtype=np.int32)),
                    pa.array(vector * trained),
                    pa.array(np.full(len(vector), float(trained))),
                ],
                names=["place", "total", "words"],
            )

    rows = entries.mapInArrow(train, "place int, total double, words double")
    mean = rows.groupBy("place").agg((F.sum("total") / F.sum("words")).alias("value")).collect()
    vector = start.copy()
    for r in mean:
        vector[r.place] = r.value
    return vector


def train(coded: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Weights from all coded documents, the same for the same rows in any files.

    Rows that are equal in id and text are in one share; a table that repeats one such row
    very often makes a long task.
    """

    def dealt(some: DataFrame, part: int) -> DataFrame:
        shares = -(-vocabulary.n_words // (SHARE * part)) or 1
        return some.repartition(shares, "h").sortWithinPartitions("h", "entries").select("entries")

    rows = coded.select("h", "entries")
    start = Network.random(side=vocabulary.side).vector()
    first = dealt(rows.where(F.pmod("h", F.lit(16)) == 0), 16)
    return train_round(dealt(rows, 1), vocabulary.side, train_round(first, vocabulary.side, start, 0.1), 0.05)


def learn(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and weights from all documents."""
    vocabulary = learn_vocabulary(docs, text_col)
    return vocabulary, train(coded_documents(docs, vocabulary, id_col, text_col), vocabulary)


def score_documents(
    docs: DataFrame, model: tuple[Vocabulary, np.ndarray], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, log_likelihood (the sum), mean_log.

    Null and empty texts have no words, a sum of 0 and a null mean; repeated rows and
    null ids stay; further columns are left behind. A word that was not counted when
    the model was learned has the share of one more word of its bucket.
    """
    return score_coded(coded_documents(docs, model[0], id_col, text_col), model)


def learn_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scores of documents under the model learned from them, which are coded once."""
    vocabulary = learn_vocabulary(docs, text_col)
    coded = coded_documents(docs, vocabulary, id_col, text_col)
    return score_coded(coded, (vocabulary, train(coded, vocabulary)))


def score_coded(coded: DataFrame, model: tuple[Vocabulary, np.ndarray]) -> DataFrame:
    """``score_documents`` for coded documents."""
    vocabulary, weights = model
    side = vocabulary.side

    @lean.released
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.of_vector(weights, side).fixed()
        for batch in batches:
            for some in lean.sliced(batch, 500):
                flat, at, counts = padded_column(some.column(3), side * side)
                logs = [network.log_probability(flat, at[a : a + BLOCK]) for a in range(0, len(at), BLOCK)]
                sums = np.concatenate([[0.0], np.cumsum(np.concatenate([*logs, np.empty(0)]))])
                ends = np.cumsum(counts)
                partly = sums[ends] - sums[ends - counts] + some.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(counts), pa.array(partly)],
                    names=["row", "doc_id", "n_words", "partly"],
                )

    kind = coded.schema["doc_id"].dataType.simpleString()
    scored = coded.select("row", "doc_id", "inside", "entries").mapInArrow(
        score, f"row long, doc_id {kind}, n_words long, partly double"
    )
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.times").alias("times")
    )
    totals = F.array(*(F.lit(float(x)) for x in vocabulary.totals))
    in_bucket = F.element_at(totals, bucket_of(F.col("word")) + 1)
    share = F.coalesce(F.col("n") / in_bucket, 1 / (in_bucket + 1))
    if vocabulary.counts is None:
        counted = rare.withColumn("n", F.lit(None).cast("long"))
    else:
        counted = rare.join(vocabulary.counts, "word", "left")
    more = counted.groupBy("row").agg(F.sum(F.col("times") * F.log(share)).alias("more"))
    whole = scored.join(more, "row", "left").select(
        "doc_id", "n_words", (F.col("partly") + F.coalesce("more", F.lit(0.0))).alias("log_likelihood")
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return whole.withColumn("mean_log", mean)
