"""Secret scans: patterns, and a linear-chain conditional random field beside them.

The patterns give the base spans. The field tags every token of a text as the
begin of a secret, inside one, or outside; its weights cover a token's shape, the
two words before and the one after it, and how much of the file looks like
settings. It is trained in numpy on windows around base spans (weak labels, with
the neighbouring words and the shape each hidden at random, so that either alone
suffices), on copies of them in which value and key word are replaced by others that no
base pattern knows, and on windows without any. Viterbi decoding runs over many texts at
once. What a tagged run has outside the base spans is added as kind ``crf``.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import lean, words

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# Any of these must be there for an assignment to match; a cheap look ahead.
KEYWORD = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)

TOKEN = re.compile(r"[\w+/.\-]+={0,2}|[^\w\s]")
WORD = re.compile(r"[^\W_]")
OUT, BEGIN, INSIDE = 0, 1, 2
#: Buckets for the identity of a neighbouring word.
BUCKETS = 1024

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of every base match that is long enough, by start, then kind."""
    found = [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    if KEYWORD.search(text):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]


def secret_values(text: str) -> list[tuple[int, int]]:
    """The characters that are secret in the base matches; a weak label."""
    spans = [(m.start(), m.end()) for m in HEX.finditer(text)]
    spans += [(m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return spans


def shape(token: str) -> list[int]:
    """Numbers of the shape features of a token, each below ``SHAPES``."""
    n = len(token)
    length = bisect_right(LENGTHS, n)
    digits = sum(map(str.isdigit, token))
    upper = sum(map(str.isupper, token))
    lower = sum(map(str.islower, token))
    other = n - digits - upper - lower
    mix = (digits > 0) + 2 * (upper > 0) + 4 * (lower > 0) + 8 * (other > 0)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:])) if digits else 0
    features = [
        length,
        12 + mix,
        28 + min(changes, 7),
        36 + min(len(set(token)) // 3, 7),
        44 + (12 * (digits > 0) + min(length, 11)),
        68 + (8 * digits // n if n else 0),
    ]
    if n >= 12 and digits and not token.strip("0123456789abcdef"):
        features.append(77)
    if n >= 12 and digits and upper and lower:
        features.append(78)
    if n >= 12 and not token.isascii():
        features.append(79)
    return features


SHAPES = 80
LENGTHS = [2, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64]
FILE = 3  # share of setting-like signs: none, some, many


def word_bucket(token: str) -> int:
    """Which bucket a neighbouring word falls into, by its first letters."""
    return zlib.crc32(token[:16].lower().encode()) % BUCKETS


def file_feature(text: str) -> int:
    share = (text.count("=") + text.count(":") + text.count('"')) / (len(text) + 1)
    return 0 if share < 0.002 else 1 if share < 0.02 else 2


@dataclass(frozen=True)
class Field:
    """Weights of a trained field: shapes, neighbour words, file, transitions."""

    shapes: np.ndarray  # SHAPES x 3
    neighbours: np.ndarray  # 3 x BUCKETS x 3
    file: np.ndarray  # FILE x 3
    moves: np.ndarray  # 3 x 3, from row to column


class Tagger:
    """Tags the texts of a batch with one field; remembers shape and bucket of tokens."""

    REMEMBERED = 150_000
    LONGEST = 64  # longer tokens are looked at each time

    def __init__(self, crf: Field):
        self.crf = crf
        self.moves = crf.moves.astype(np.float32)
        self.neighbours = crf.neighbours.astype(np.float32)
        self.numbers: dict[str, int] = {}
        self.shape_of, self.bucket_of = array("i"), array("i")
        self.shape_numbers: dict[tuple[int, ...], int] = {}
        self.shape_scores: list[np.ndarray] = []

    def _number(self, token: str) -> int:
        features = tuple(shape(token))
        of_shape = self.shape_numbers.get(features)
        if of_shape is None:
            of_shape = self.shape_numbers[features] = len(self.shape_scores)
            self.shape_scores.append(self.crf.shapes[list(features)].sum(axis=0))
        number = len(self.shape_of)
        if len(token) <= self.LONGEST:
            self.numbers[token] = number
        self.shape_of.append(of_shape)
        self.bucket_of.append(word_bucket(token))
        return number

    def emissions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all tokens of all texts in one line, and which text each is of."""
        if len(self.shape_of) > self.REMEMBERED:
            self.numbers.clear()
            self.shape_of, self.bucket_of = array("i"), array("i")
        get, line, counts = self.numbers.get, [], []
        for text in texts:
            tokens = TOKEN.findall(text)
            counts.append(len(tokens))
            numbers = [get(t) for t in tokens]
            if None in numbers:
                numbers = [
                    (get(t) if get(t) is not None else self._number(t)) if k is None else k
                    for k, t in zip(numbers, tokens)
                ]
            line += numbers
        of_text = np.repeat(np.arange(len(texts)), counts)
        features = np.array([file_feature(t) for t in texts], dtype=np.int64)
        if not line:
            return np.empty((0, 3), dtype=np.float32), of_text
        numbers = np.array(line)
        shapes = np.array(self.shape_of, dtype=np.int32)[numbers]
        buckets = np.array(self.bucket_of, dtype=np.int32)[numbers]
        scores = np.array(self.shape_scores, dtype=np.float32)[shapes]
        scores += self.crf.file.astype(np.float32)[features[of_text]]
        for role, back in ((0, 1), (1, 2)):
            same = (of_text[back:] == of_text[:-back])[:, None]
            scores[back:] += self.neighbours[role][buckets[:-back]] * same
        same = (of_text[1:] == of_text[:-1])[:, None]
        scores[:-1] += self.neighbours[2][buckets[1:]] * same
        return scores, of_text

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """The best tags of each text.

        A token whose score for OUT leads by more than two transitions can ever give
        back is OUT on every best path. Such tokens cut a text into short chains, and
        only these are decoded, with the transitions at both cuts.
        """
        scores, of_text = self.emissions(texts)
        tags = np.zeros(len(scores), dtype=np.int8)
        swing = 2 * (self.moves.max() - self.moves.min())
        open_ = np.flatnonzero(scores[:, OUT] - scores[:, 1:].max(axis=1) <= swing)
        if len(open_):
            cut = np.flatnonzero((np.diff(open_) > 1) | (np.diff(of_text[open_]) > 0)) + 1
            runs = np.split(open_, cut)
            chains = []
            for run in runs:
                a, b = run[0], run[-1] + 1
                chain = scores[a:b].copy()
                if a and of_text[a - 1] == of_text[a]:
                    chain[0] += self.moves[OUT]
                if b < len(scores) and of_text[b] == of_text[b - 1]:
                    chain[-1] += self.moves[:, OUT]
                chains.append(chain)
            for run, best in zip(runs, viterbi(chains, self.moves)):
                tags[run] = best
        return np.split(tags, np.searchsorted(of_text, np.arange(1, len(texts))))

    def extra_spans(self, text: str, tags: np.ndarray, least: int = 8) -> list[tuple[int, int]]:
        """Character spans of the tagged runs of at least ``least`` characters."""
        if not tags.any():
            return []
        spans: list[list[int]] = []
        inside = False
        for m, tag in zip(TOKEN.finditer(text), tags):
            if tag == OUT:
                inside = False
            elif tag == INSIDE and inside:
                spans[-1][1] = m.end()
            else:
                spans.append([m.start(), m.end()])
                inside = True
        return [(a, b) for a, b in spans if b - a >= least]


    def spans(self, text: str, tags: np.ndarray) -> list[Span]:
        """The base spans, and what tagged runs have outside them where a word character is."""
        base = base_spans(text)
        more = [
            (x, y, "crf")
            for a, b in self.extra_spans(text, tags)
            for x, y in beside(a, b, base)
            if WORD.search(text, x, y)
        ]
        return sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[2])))


def viterbi(emissions: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Best paths of many chains at once; of equal paths the one with the lower tags."""
    lengths = np.array([len(e) for e in emissions], dtype=np.int64)
    paths = [np.zeros(n, dtype=np.int8) for n in lengths]
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return paths
    flat = np.concatenate([emissions[i] for i in order])
    starts = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
    sizes = lengths[order]
    back = np.zeros((len(flat), 3), dtype=np.int8)
    moves = moves.astype(np.float32)
    score = flat[starts].copy()
    alive = len(order)
    for t in range(1, int(sizes[0])):
        while sizes[alive - 1] <= t:
            alive -= 1
        at = starts[:alive] + t
        through = score[:alive, :, None] + moves
        best = through.argmax(axis=1)
        back[at] = best
        score[:alive] = np.take_along_axis(through, best[:, None, :], axis=1)[:, 0] + flat[at]
    tags = np.zeros(len(flat), dtype=np.int8)
    now = score.argmax(axis=1)
    tags[starts + sizes - 1] = now
    for t in range(int(sizes[0]) - 1, 0, -1):
        alive = int(np.searchsorted(-sizes, -t, side="left"))  # chains longer than t
        at = starts[:alive] + t
        now[:alive] = back[at, now[:alive]]
        tags[at - 1] = now[:alive]
    for k, i in enumerate(order):
        paths[i] = tags[starts[k] : starts[k] + sizes[k]]
    return paths


Window = tuple[list[str], list[int], int]
#: Windows taken from one row at most, those whose hashes are lowest.
PER_ROW = 32


def training_windows(text: str, reach: int = 10) -> list[Window]:
    """Token windows around each secret value, one from the middle of the text and one around
    its longest token outside the values, which is most like a secret.

    Of a text with more than ``PER_ROW`` values those windows that hash lowest.
    """
    values = sorted(secret_values(text))
    starts = [a for a, _ in values]
    tokens, tags, centres = [], [], []
    for m in TOKEN.finditer(text):
        tag = OUT
        # The values that begin before the token ends; the last of them reaches furthest or all overlap.
        for a, b in values[max(0, bisect_right(starts, m.end() - 1) - 3) : bisect_right(starts, m.end() - 1)]:
            if m.start() < b:
                tag = BEGIN if m.start() <= a else INSIDE
                if tag == BEGIN:
                    centres.append(len(tokens))
                break
        tokens.append(m[0])
        tags.append(tag)
    feature = file_feature(text)

    def window(centre: int) -> Window:
        part = slice(max(0, centre - reach), centre + reach)
        return tokens[part], tags[part], feature

    found = [window(c) for c in centres]
    if len(found) > PER_ROW:
        found = sorted(found, key=lambda w: (zlib.crc32(" ".join(w[0]).encode()), w))[:PER_ROW]
    if not tokens:
        return []
    longest = max(range(len(tokens)), key=lambda k: (tags[k] == OUT) * len(tokens[k]))
    return [*found, window(len(tokens) // 2), window(longest)]


# Words that announce a secret and that no base pattern knows.
KEY_WORDS = ("passphrase", "pwd", "pin", "bearer", "auth", "credential", "credentials", "apikey", "private_key", "client_key", "session_key", "signature")
ALPHANUMERIC = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
#: Starts of issued keys, and how many characters follow.
ISSUED = (("sk_live_", 24), ("ghp_", 36), ("xoxb-", 28), ("", 40), ("", 22), ("rk_", 30))


def varied(windows: list[Window], copies: int = 2, seed: int = 11) -> list[Window]:
    """Copies of the windows that hold one secret, each with another value and key word.

    Values are issued keys, passphrases of known words joined by hyphens, and random text;
    key words stand before them with a sign between. A third of the copies of keys keep no
    announcing word at all, so that their shape alone must do.
    """
    random = np.random.default_rng(seed)
    plain = sorted({t.lower() for tokens, tags, _ in windows for t, g in zip(tokens, tags) if g == OUT and t.isalpha() and 3 <= len(t) <= 9})
    made = []
    for tokens, tags, feature in windows * copies:
        begin = [k for k, tag in enumerate(tags) if tag == BEGIN]
        if len(begin) != 1 or not plain:
            continue
        first = begin[0]
        last = first + 1
        while last < len(tags) and tags[last] == INSIDE:
            last += 1
        words_only = random.random() < 0.3
        if words_only:
            value = "-".join(random.choice(plain, int(random.integers(3, 6))))
        else:
            start, length = ISSUED[int(random.integers(len(ISSUED)))]
            value = start + "".join(random.choice(list(ALPHANUMERIC), length))
        if words_only or random.random() < 0.67:
            key = str(random.choice(KEY_WORDS))
            lead = [key.upper() if random.random() < 0.2 else key] + ([] if key == "bearer" else [str(random.choice([":", "="]))])
        else:
            lead = list(map(str, random.choice(plain, 2)))
        parts = TOKEN.findall(value)
        before = [t for t in tokens[: max(0, first - 3)]]
        kept = list(zip(before, tags)) + [(t, OUT) for t in lead]
        kept += [(t, INSIDE if k else BEGIN) for k, t in enumerate(parts)]
        kept += list(zip(tokens[last:], tags[last:]))
        made.append(([t for t, _ in kept][:24], [g for _, g in kept][:24], feature))
    return made


def fit(windows: list[Window], rounds: int = 150, seed: int = 7) -> Field:
    """Trains by gradient ascent on the log-likelihood, with a quadratic penalty.

    The gradient is the difference of observed and expected feature counts, the
    latter by the forward-backward recursion over all windows at once. Without
    any window the field has no weights and tags nothing.
    """
    shapes, neighbours = np.zeros((SHAPES, 3)), np.zeros((3, BUCKETS, 3))
    file, moves = np.zeros((FILE, 3)), np.zeros((3, 3))
    windows = [w for w in windows if len(w[0]) >= 2]
    if not windows:
        return Field(shapes, neighbours, file, moves)
    n, width = len(windows), max(len(w[0]) for w in windows)
    own = np.full((n, width, 9), SHAPES, dtype=np.int64)
    near = np.full((n, width, 3), BUCKETS, dtype=np.int64)
    tags = np.zeros((n, width), dtype=np.int64)
    real = np.zeros((n, width), dtype=bool)
    kind = np.array([w[2] for w in windows])
    for i, (tokens, gold, _) in enumerate(windows):
        buckets = [word_bucket(t) for t in tokens]
        for j, token in enumerate(tokens):
            f = shape(token)
            own[i, j, : len(f)] = f
            near[i, j] = (
                buckets[j - 1] if j else BUCKETS,
                buckets[j - 2] if j > 1 else BUCKETS,
                buckets[j + 1] if j + 1 < len(tokens) else BUCKETS,
            )
        tags[i, : len(tokens)] = gold
        real[i, : len(tokens)] = True
    gold = np.eye(3)[tags] * real[:, :, None]
    pair = np.einsum("ita,itb->ab", gold[:, :-1], gold[:, 1:])
    params = [shapes, neighbours, file, moves]
    speed = [np.full(p.shape, 1e-8) for p in params]
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        hide = random.random((n, 2)) < 0.25
        o = np.where(hide[:, 0, None, None] & ~hide[:, 1, None, None], SHAPES, own)
        v = np.where(hide[:, 1, None, None] & ~hide[:, 0, None, None], BUCKETS, near)
        e = np.vstack([shapes, np.zeros((1, 3))])[o].sum(axis=2) + file[kind][:, None, :]
        for role in range(3):
            e += np.vstack([neighbours[role], np.zeros((1, 3))])[v[:, :, role]]
        e = np.where(real[:, :, None], e, 0.0)
        marginal, expected_pair = expectations(e, moves, real)
        difference = (gold - marginal) * real[:, :, None]
        each = [np.ascontiguousarray(difference[:, :, tag]).ravel() for tag in range(3)]
        repeated = [np.repeat(d, o.shape[2]) for d in each]
        grads = [
            np.stack([np.bincount(o.ravel(), r, SHAPES + 1) for r in repeated], axis=1)[:-1],
            np.stack(
                [np.stack([np.bincount(v[:, :, role].ravel(), d, BUCKETS + 1) for d in each], axis=1)[:-1] for role in range(3)]
            ),
            np.stack([np.bincount(kind, difference[:, :, tag].sum(axis=1), FILE) for tag in range(3)], axis=1),
            pair - expected_pair,
        ]
        for p, g, s in zip(params, grads, speed):
            g = g / n - 1e-3 * p
            s += g * g
            p += 0.3 * g / np.sqrt(s)
    return Field(shapes, neighbours, file, moves)


def expectations(e: np.ndarray, moves: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected tags and expected neighbouring tag pairs under the current weights."""
    n, width, _ = e.shape
    forward, backward = np.empty_like(e), np.zeros_like(e)

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    forward[:, 0] = e[:, 0]
    for t in range(1, width):
        step = total(forward[:, t - 1, :, None] + moves, 1) + e[:, t]
        forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
    norm = total(forward[:, -1], 1)
    for t in range(width - 2, -1, -1):
        step = total(moves[None] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(real[:, t + 1, None], step, 0.0)
    marginal = np.exp(forward + backward - norm[:, None, None])
    pair = np.zeros((3, 3))
    for t in range(width - 1):
        joint = forward[:, t, :, None] + moves + (e[:, t + 1] + backward[:, t + 1])[:, None, :]
        pair += (np.exp(joint - norm[:, None, None]) * real[:, t + 1, None, None]).sum(axis=0)
    return marginal, pair


def learn(
    docs: DataFrame, max_rows: int = 60_000, clean_every: int = 30, id_col: str = "doc_id", text_col: str = "text"
) -> Field:
    """A field from about ``max_rows`` rows, chosen by a hash of id and text.

    Of rows with base spans the windows around them are used (``PER_ROW`` of a row at most),
    of the others one window of every ``clean_every``-th row. Rows that are equal in both
    are chosen together and give their windows once, so what reaches the driver has a bound.
    """

    kind = "tokens array<string>, tags array<int>, file int"

    @lean.released
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in lean.sliced(batch):
                found: list[Window] = []
                for text, use in zip(some.column(0), some.column(1)):
                    text = text.as_py()
                    if use.as_py() or base_spans(text):
                        found += training_windows(text)
                columns = ([w[k] for w in found] for k in range(3))
                types = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, types)], names=["tokens", "tags", "file"]
                )

    share = int(1_000_000 * min(1.0, max_rows / max(docs.count(), 1)))
    text = words.text_or_empty(text_col)
    number = F.xxhash64(F.col(id_col).cast("string"), text)
    rows = docs.where(F.pmod(number, F.lit(1_000_000)) < share).select(
        text.alias("text"), (F.pmod(F.shiftright(number, 20), F.lit(clean_every)) == 0).alias("clean")
    )
    taken = rows.mapInArrow(windows, kind).distinct().collect()
    order = sorted((list(r.tokens), list(r.tags), r.file) for r in taken)
    return fit(order + varied(order))


def beside(a: int, b: int, base: list[Span]) -> list[tuple[int, int]]:
    """What the characters from a to b have outside the base spans, which come in order."""
    parts = []
    for x, y, _ in base:
        if y <= a or x >= b:
            continue
        if a < x:
            parts.append((a, x))
        a = max(a, y)
    return [*parts, (a, b)] if a < b else parts


def spans(text: Column, crf: Field) -> Column:
    """All spans of a text column, base ones first found, then those the field adds.

    An array of (start, end, kind) by start, then kind; code points, end exclusive.
    """

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    @F.arrow_udf("array<struct<start: bigint, end: bigint, kind: string>>")
    @lean.released
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(crf)
        for texts in batches:
            results: list[pa.Array] = []
            for some in lean.sliced(texts):
                part = [t or "" for t in some.to_pylist()]
                rows = [tagger.spans(text, tags) for text, tags in zip(part, tagger.tag(part))]
                results.append(
                    pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in r] for r in rows], type=kind)
                )
            yield pa.concat_arrays(results) if results else pa.array([], type=kind)

    return scan(text)


def scan_documents(
    docs: DataFrame, crf: Field, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id and its array of spans.

    Null and empty texts have no span; repeated rows and null ids stay; further
    columns are left behind. No shuffle.
    """
    text = words.text_or_empty(text_col)
    return docs.select(F.col(id_col), spans(text, crf).alias("spans"))


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced; spans that overlap become one mark."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    merged = F.aggregate(
        found,
        start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(
                    acc["done"],
                    text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                    F.lit(mark),
                ).alias("done"),
                s["end"].alias("at"),
            ),
        ).otherwise(
            F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))
        ),
        lambda acc: F.concat(
            acc["done"], text.substr((acc["at"] + 1).cast("int"), F.length(text) - acc["at"].cast("int"))
        ),
    )
    return F.when(F.size(found) == 0, text).otherwise(merged)
