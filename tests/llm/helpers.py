"""Small documents with every awkward case, and brute-force helpers."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = (
    "the river ran past seven old mills before it met the wide grey sea and every miller "
    "knew the songs that the water sang in spring when snow came down from the far hills "
    "to fill the ponds and turn the heavy wheels that ground the corn of nine villages "
    "while children counted boats and geese along the muddy banks until the bells rang"
)


def near_copies(count: int) -> list[tuple[int, str]]:
    """Documents of which later ones differ from the first in more and more words."""
    base = PROSE.split() * 3
    made = []
    for k in range(count):
        words = list(base)
        for j in range(k):
            words[(37 * j + 5) % len(words)] = f"changed{k}x{j}"
        made.append((100 + k, " ".join(words)))
    return made


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three"), (6, "One TWO three"),
    (7, "é ü 漢字 \U0001f600 end"), (8, "x" * 3000), (9, PROSE), (9, PROSE), (None, PROSE),
    (None, None), (10, PROSE.upper()), (11, "word " * 5000), (12, "a b c d e"), (13, "a b c d e f"),
]


def frame(spark, rows, extra=True):
    """doc_id and text, with further columns whose names clash with results."""
    schema = "doc_id long, text string"
    if not extra:
        return spark.createDataFrame(rows, schema)
    more = "n long, f long, sig long, node long, score double, spans string, id string, label int, k int, start long, length long, w string"
    width = more.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * width) for r in rows], f"{schema}, {more}")


def shingle_set(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(rows):
    """Smallest id reachable by links, by comparing all pairs."""
    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: find(d) for d, _ in sets}
