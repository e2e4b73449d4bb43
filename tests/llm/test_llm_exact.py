"""Operators with exact answers: hard negatives, Merkle manifest, byte-level BPE."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, PROSE, frame

from tallyworks.llm import forced_boundary, merkle, queries, residue_gemm
from tallyworks.llm.queries import vocabulary

BPE = vocabulary("byte_bpe_50k.json")


# Byte-level BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def codec():
    return forced_boundary.Codec(BPE)


ODD = [
    "", " ", "\n\nb", "a\n\n\nb", "a  b", "a \n b ", "don't can't we'll", "!'s ?'re x'S '''s", "x\x1cy\x1fz\x85 \xa0 q",
    "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftex", "漢字 кириллица éàü \U0001f600\U0001f601", " 　 a b",
    "é ́", "�\u0000", "zq zxq qxz jqvx", "'" * 50, "a" * 700, "ab" * 900, " " * 300 + "x", "\t\n" * 40, "1234567 ½ ² ٣",
]


def test_codec_equals_the_library(codec, library):
    rnd = random.Random(5)
    letters = [*" \n\t'sdtrevml!?.,()aAzéü0199qxzjк漢字\U0001f600\xa0 　́_-", "<|endoftext|>", "'re", "don't"]
    texts = [*ODD, *("".join(rnd.choices(letters, k=rnd.randrange(30))) for _ in range(5000))]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        coded = codec.encode(text.encode())
        assert np.frombuffer(coded, dtype="<u4").tolist() == expected, text
        assert codec.decode(coded) == library.decode(expected, skip_special_tokens=False), text


def test_every_character_between_neighbours(codec, library):
    """Classes of characters are the library's, wherever a cut falls."""
    some = [c for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000] + [*range(1, 0x3100)]
    texts = [f"a{c}1{c} {c}{c}b!{c}\n{c}x" for c in map(chr, some)]
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(codec.encode(text.encode()), dtype="<u4").tolist() == expected.ids, text


def test_cuts_lie_inside_no_token(codec):
    cuts = codec.certain.reshape(256, 256)
    for token in codec.tokens:
        if token not in codec.specials:
            assert not any(cuts[a, b] for a, b in zip(token, token[1:]))
    fragments = codec.fragments(PROSE.encode())
    assert b"".join(fragments) == PROSE.encode() and len(fragments) > 60
    # Each fragment is encoded on its own, and that is the encoding of the whole.
    assert b"".join(map(codec.encode, fragments)) == codec.encode(PROSE.encode())


def test_both_merge_loops_agree(codec):
    rnd = random.Random(2)
    for _ in range(400):
        ids = [codec.byte_ids[rnd.choice(b"abetonrs ")] for _ in range(rnd.randrange(1, 60))]
        assert codec._merged_short(list(ids)) == codec._merged_long(list(ids))


def test_decode_of_any_ids(codec, library):
    rnd = random.Random(8)
    for _ in range(500):
        ids = [rnd.randrange(50_257) for _ in range(rnd.randrange(12))]
        assert codec.decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode(np.array([50_300, 64], dtype="<u4").tobytes()) == codec.tokens[64].decode()


def test_one_long_fragment_ends(codec):
    ids = np.frombuffer(codec.encode(b"a" * 200_000), dtype="<u4")
    assert b"".join(codec.tokens[i] for i in ids) == b"a" * 200_000


def test_bpe_query(spark, tmp_path, library):
    rows = [*AWKWARD, *enumerate(ODD, 100)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(map(tuple, queries.op13_byte_bpe(spark, str(tmp_path)).collect()))
    expected = Counter()
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, dtype="<u4").tobytes()
        expected[doc, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    assert got == expected
    assert forced_boundary.encode_documents(frame(spark, []), BPE).count() == 0
    coded = forced_boundary.encode_documents(frame(spark, rows), BPE)
    back = Counter(map(tuple, forced_boundary.decode_documents(coded, BPE).collect()))
    assert back == Counter((doc, text or "") for doc, text in rows)


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def root_of(nodes):
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0]


def way_up(nodes, at):
    """(left, right) digests of each level from a node to the root."""
    way = []
    while len(nodes) > 1:
        run = at - at % 16
        way.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at //= 16
    return way


def expected_manifest(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    names = sorted(by_source, key=lambda s: b"" if s is None else b"=" + s.encode())
    trees = [sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in by_source[n]), key=lambda t: t[:3]) for n in names]
    tops = [root_of([t[2] for t in tree]) for tree in trees]
    root, out = root_of(tops), Counter()
    for k, tree in enumerate(trees):
        leaves = [t[2] for t in tree]
        for at, (_, _, leaf, row) in enumerate(tree):
            way = way_up(leaves, at) + way_up(tops, k)
            cur = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                lowered = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                cur = leaf_of((*row[:4], lowered))
            for left, right in way:
                cur = sha(left + cur + right)
            out[row[0], leaf, tops[k], root, sha("".join(a + b for a, b in way)), cur, cur == root] += 1
    return out


def manifest(spark, tmp_path, rows, name):
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank long, digest string, path string"
    folder = f"{tmp_path}/{name}"
    made = spark.createDataFrame([(*r, "x", 5, "y", "z") for r in rows], schema)
    made.write.parquet(f"{folder}/documents.parquet")
    got = queries.op12_merkle_manifest(spark, folder).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    return Counter(map(tuple, got.collect()))


@pytest.mark.parametrize("name", ["many", "one", "lone sources", "one source", "copies", "none"])
def test_manifest_equals_plain_trees(spark, tmp_path, name):
    rnd = random.Random(4)
    many = [
        (i * 3 % 1009, rnd.choice(["a", "a", "a", "é", "", "zz", None]), rnd.choice(["en", None]), rnd.choice([5, None]),
         rnd.choice([None, "", "Some TEXT", "lower", PROSE.title(), "漢字 É"]))
        for i in range(700)
    ]
    many += [(None, "a", None, None, "no id"), (None, None, None, None, None), (None, "a", None, None, "no id")]
    rows = {
        "many": many,
        "one": [(7, "s", "en", 1, "Alone")],
        "lone sources": [(i, f"s{i:03}", "en", 1, "T") for i in range(40)],
        "one source": [(i, "s", "en", 1, f"Text {i}") for i in range(257)],
        "copies": [(5, "s", "en", 1, "Same TEXT")] * 300 + [(6, "t", "en", 1, "x")] * 17,
        "none": [],
    }[name]
    assert manifest(spark, tmp_path, rows, name) == (expected_manifest(rows) if rows else Counter())


def test_requests_for_some_leaves(spark):
    nodes = [(f"={t}", i, sha(f"{t}{i}")) for t, n in (("a", 300), ("b", 1), ("c", 16)) for i in range(n)]
    made = spark.createDataFrame([(t[1:], i, d) for t, i, d in nodes], "name string, place long, digest string")
    from pyspark.sql import functions as F

    built = merkle.build(made, F.col("name"), [F.asc("place")], ["place"])
    asked = built.leaves.where("place in (0, 15, 299) and tree != '=c'")
    rows = merkle.prove(built, asked).collect()
    assert sorted((r.tree, r["rank"]) for r in rows) == [("=a", 0), ("=a", 15), ("=a", 299), ("=b", 0)]
    by = defaultdict(list)
    for t, _, d in nodes:
        by[t].append(d)
    tops = [root_of(by[t]) for t in sorted(by)]
    for r in rows:
        way = way_up(by[r.tree], r["rank"]) + way_up(tops, sorted(by).index(r.tree))
        assert [(s.left, s.right) for s in r.path] == way and r.root == root_of(tops)


def test_no_task_holds_a_tree(spark, plan, tmp_path):
    """Nodes are grouped by run, never by tree alone."""
    nodes = spark.range(1000).selectExpr("'t' AS tree", "id AS rank", "sha2(cast(id AS string), 256) AS digest")
    forest = merkle.grow(nodes)
    assert len(forest.levels) == 3
    assert [level.count() for level in forest.levels] == [63, 4, 1]
    for level in forest.levels:
        assert level.selectExpr("max(size(children)) AS n").first().n <= 16


# Hard negatives


def expected_negatives(rows, anchors, positives=5, negatives=10):
    fit = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    heads = {}
    for i, label, v in sorted(fit):
        if anchors(i):
            heads.setdefault(i, (label, v))
    out = Counter()
    for a, (label, v) in heads.items():
        near = [(-sum(x * y for x, y in zip(v, w)), i, l) for i, l, w in fit if i != a and len(w) == len(v)]
        for s, p, _ in sorted(n for n in near if n[2] == label)[:positives]:
            far = sorted(n[:2] for n in near if n[2] != label and 30 * -s <= 100 * -n[0] <= 90 * -s)
            for k, (t, i) in enumerate(far[:negatives], 1):
                out[a, p, k, i, -s, -t] += 1
    return out


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, id long, anchor boolean, place long, vector string, score long"
    return spark.createDataFrame([(*r, 1, False, 2, "x", 3) for r in rows], schema)


def some_vectors(n, dims, seed, spread=0.2):
    rnd = np.random.default_rng(seed)
    heart = rnd.normal(0, spread, dims)
    return [(i, [float(np.float32(x)) for x in heart + rnd.normal(0, spread, dims)], int(rnd.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("name", ["plain", "awkward", "copies", "wide", "none"])
def test_negatives_equal_brute_force(spark, rows, name):
    from pyspark.sql import functions as F

    plain = some_vectors(420, 8, 1)
    awkward = plain[:200] + [
        (300, None, 1), (None, plain[0][1], 1), (301, plain[1][1], None), (302, [None, *plain[1][1][1:]], 1),
        (303, [math.nan] * 8, 1), (304, [math.inf, *plain[2][1][1:]], 0), (305, [], 1), (306, plain[3][1][:5], 1),
        (400, plain[5][1], 0), (400, plain[6][1], 1), (100, plain[7][1], 2), (310, [], 2), (320, plain[4][1][:5], 2),
    ]
    data = {
        "plain": plain,
        "awkward": awkward,
        "copies": plain[:60] + [(1000 + i, plain[0][1], i % 2) for i in range(150)] + plain[:60],
        "wide": some_vectors(150, 300, 3, spread=8.0),
        "none": [],
    }[name]
    got = residue_gemm.hard_negatives(vectors(spark, data), F.col("vec_id") % 20 == 0)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert Counter(rows(got, *columns)) == expected_negatives(data, lambda i: i % 20 == 0)


def test_tiles_do_not_change_the_answer(spark, rows, monkeypatch):
    from pyspark.sql import functions as F

    data = some_vectors(300, 6, 9)
    monkeypatch.setattr(residue_gemm, "TILE_ROWS", 37)
    monkeypatch.setattr(residue_gemm, "TILE_ANCHORS", 7)
    got = residue_gemm.hard_negatives(vectors(spark, data), F.col("vec_id") % 10 == 0)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert Counter(rows(got, *columns)) == expected_negatives(data, lambda i: i % 10 == 0)


def test_residues_give_exact_scores():
    rnd = np.random.default_rng(0)
    for dims, most in ((1, 3), (64, 256), (64, 5_000_000), (768, 40_000), (4096, 900)):
        a, b = rnd.integers(-most, most + 1, (5, dims)), rnd.integers(-most, most + 1, (9, dims))
        a[0], b[0], b[1] = most, most, -most
        primes = residue_gemm.primes_for(dims, most)
        got = residue_gemm.exact_scores(residue_gemm.residues(a, primes), residue_gemm.residues(b, primes), primes)
        assert (got == a @ b.T).all()
    with pytest.raises(ValueError):
        residue_gemm.primes_for(64, 1 << 40)


def test_first_keeps_ties_in_order():
    scores = np.array([[3, 5, 5, 1, 5], [0, 0, 0, 0, 0]])
    eligible = np.array([[True, True, True, True, False], [False, True, False, True, True]])
    row, column = residue_gemm.first(scores, eligible, 2)
    assert [*zip(row.tolist(), column.tolist())] == [(0, 1), (0, 2), (1, 1), (1, 3)]
