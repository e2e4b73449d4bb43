"""Chat formatting, packing, secret scans and HTML extraction."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, PROSE, frame

from tallyworks.llm import chat_format, html_content, packing, queries, secret_scan
from tallyworks.llm.queries import vocabulary

TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|>\n there \\ \\\\ <\\| x"), (1, 2, "assistant", "<|im_start|>assistant\nno\\"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (2, 0, "user", PROSE * 30), (2, 1, "assistant", PROSE * 40),
    (2, 2, "user", "ok"), (2, 3, "assistant", "fine"), (3, 0, "assistant", "first"), (3, 0, "assistant", "first"),
    (3, 1, None, "no role"), (3, None, "odd\nrole<|\\", "null turn"), (4, 0, "system", "alone"), (None, 0, "user", "no id"),
    *[(5, t, ("user", "assistant")[t % 2], f"turn {t} " + PROSE[: 40 * (t % 7)]) for t in range(60)],
    (6, 0, "system", PROSE), *[(6, t, ("user", "assistant")[t % 2], PROSE) for t in range(1, 40)],
]


def conversations(spark):
    return spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, window string")


def ordered():
    held = defaultdict(list)
    for conv, turn, role, text in TURNS:
        held[conv].append((-1 if turn is None else turn, role or "", text or ""))
    return {k: sorted(v) for k, v in held.items()}


def test_windows_read_back_whole(spark):
    rows = chat_format.format_windows(conversations(spark), budget=300, history=60)
    rows = rows.select(
        "*",
        chat_format.turns_of(rows.text, rows.n_context).alias("turns"),
        chat_format.loss_text(rows.text, rows.loss).alias("target"),
    ).orderBy("conv_id", "window").collect()
    turns, targets = defaultdict(list), defaultdict(str)
    for r in rows:
        turns[r.conv_id] += [(t.role, t.text) for t in r.turns]
        targets[r.conv_id] += r.target
        assert r.n_turns == len(r.turns)
        assert r.n_tokens <= 300 or r.n_turns == 1
    expected = ordered()
    assert turns == {k: [t[1:] for t in v] for k, v in expected.items()}
    assert {k: targets[k] for k in turns} == {k: "".join(t[2] for t in v if t[1] == "assistant") for k, v in expected.items()}


def test_windows_repeat_system_and_history_masked(spark):
    rows = chat_format.format_windows(conversations(spark), budget=300, history=60).where("conv_id = 6").orderBy("window").collect()
    assert len(rows) > 3
    assert all(r.text.startswith("<|im_start|>system\n") for r in rows)
    later = rows[1:]
    assert all(r.n_context >= 1 for r in later)
    rows = chat_format.format_windows(conversations(spark), budget=300, history=120).where("conv_id = 5").orderBy("window").collect()
    assert any(r.n_context > 0 for r in rows)
    for r in rows:
        for span in r.loss:
            before = r.text[: span.start]
            assert before.endswith("<|im_start|>assistant\n") and before.count(chat_format.END) >= r.n_context


def test_chat_query_counts(spark, tmp_path):
    conversations(spark).drop("window").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op5_chat_format(spark, str(tmp_path)).collect()}
    expected = ordered() | {-7: [(t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))]}
    assert got.keys() == expected.keys()
    for conv, turns in expected.items():
        text = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_without_rows(spark):
    assert chat_format.format_windows(conversations(spark).limit(0)).count() == 0


def test_packing_is_whole_and_gapless(spark):
    tokenizers = pytest.importorskip("tokenizers")
    coder = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = [r for r in AWKWARD if r[0] not in (9, None)] + [(200 + k, PROSE * (k % 40) + f" <|endoftext|> {k}") for k in range(120)]
    got = packing.pack_documents(frame(spark, rows).repartition(3), vocabulary("byte_bpe_50k.tiktoken")).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, text in rows:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        own = sorted(pieces[doc], key=lambda r: r.start)
        assert b"".join(r.ids for r in own) == ids.tobytes()
        assert all(r.doc_tokens == len(ids) for r in own)
    short = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        short += at < 2048
    assert short <= 3
    crc = packing.pack_documents(frame(spark, [(1, "a")]), vocabulary("byte_bpe_50k.tiktoken")).collect()
    assert zlib.crc32(crc[0].ids) == zlib.crc32(np.array([*coder.encode("a").ids, 1], dtype="<u4").tobytes())
    assert packing.pack_documents(frame(spark, []), vocabulary("byte_bpe_50k.tiktoken")).count() == 0


def test_packer_takes_the_level_of_least_squares():
    packer = packing.Packer(10)
    rng = random.Random(6)
    placed = 0
    for _ in range(3000):
        size = rng.randint(1, 9)
        counts = packer.count.copy()

        def growth(level):
            after = counts.copy()
            if level:
                after[level] -= 1
            if level + size < 10:
                after[level + size] += 1
            return int((after[1:10] ** 2).sum())

        options = [0, *(h for h in range(1, 11 - size) if counts[h])]
        level = packer.level_for(size)
        assert growth(level) == min(map(growth, options))
        placed += sum(len(p[2]) for w in packer.add((0, 0, np.zeros(size, dtype="<u4"), size)) for p in w)
    assert packer.open < 150
    small = packing.Packer(100, max_open=5)
    done = [w for _ in range(40) for w in small.add((1, 0, np.zeros(60, dtype="<u4"), 60))] + small.pour()
    assert sum(len(p[2]) for w in done for p in w) == 2400 and small.open == 0


ORACLE_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def oracle_spans(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ORACLE_ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, k) for a, _, b, k in sorted(spans)]


def test_base_spans_by_the_plain_patterns():
    rng = random.Random(8)
    parts = ["token", "=", ": ", '"', "secret", "abcdef0123456789", "AKIA", "ABCD1234EFGH5678", "deadbeef", " ", "\n", "é", "ſecret", "toKen", "api_key", "apikey", "PASSWD", "'", "x", "KAKIA", "12"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert secret_scan.base_spans(text) == oracle_spans(text), text


def secret_docs(n=300):
    rng = random.Random(12)
    docs = []
    for k in range(n):
        text = rng.sample(PROSE.split(), 30)
        value = "".join(rng.choices("0123456789abcdef", k=40))
        if k % 3 == 0:
            text[10:10] = ["token", "=", f'"{value}"']
        docs.append((k, " ".join(text)))
    return docs


def test_field_finds_what_the_patterns_miss(spark):
    crf = secret_scan.learn(frame(spark, secret_docs()), clean_every=2)
    key = "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B"
    rows = [(1, f"the river ran past {key.lower()[:22]} token = {key.lower()} mills"), (2, PROSE), (3, None), (4, "")]
    got = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in secret_scan.scan_documents(frame(spark, rows), crf).collect()}
    assert [s for s in got[1] if s[2] != "crf"] == oracle_spans(rows[0][1])
    assert got[2] == got[3] == got[4] == []
    hidden = secret_scan.Tagger(crf).tag([f"auth : {key.lower()[:20]}g{key.lower()[:20]} end"])[0]
    assert hidden.any()
    many = secret_scan.scan_documents(frame(spark, AWKWARD), crf)
    assert many.count() == len(AWKWARD)
    nothing = secret_scan.learn(frame(spark, []))
    assert secret_scan.scan_documents(frame(spark, []), nothing).count() == 0
    assert secret_scan.scan_documents(frame(spark, AWKWARD), nothing).count() == len(AWKWARD)


def test_field_finds_planted_keys_no_pattern_knows(spark):
    """Issued keys, also of a start not trained on, bearer tokens and passphrases; prose stays."""
    crf = secret_scan.learn(frame(spark, secret_docs(1200)), clean_every=2)
    tagger, rng = secret_scan.Tagger(crf), random.Random(77)
    letters = secret_scan.ALPHANUMERIC
    forms = {
        "issued": lambda: ("", "sk_live_" + "".join(rng.choices(letters, k=24))),
        "unknown start": lambda: ("", "glpat-" + "".join(rng.choices(letters, k=20))),
        "bearer": lambda: ("Authorization: Bearer ", "".join(rng.choices(letters, k=32))),
        "passphrase": lambda: ("passphrase: ", "-".join(rng.sample(PROSE.split(), 4))),
    }
    for name, form in forms.items():
        found = 0
        for _ in range(60):
            words, (lead, value) = rng.sample(PROSE.split(), 20), form()
            assert not secret_scan.base_spans(f"{lead}{value}")
            text = " ".join(words[:10]) + f" {lead}"
            a, text = len(text), text + value + " " + " ".join(words[10:])
            spans = tagger.spans(text, tagger.tag([text])[0])
            found += any(x <= a and a + len(value) <= y and k == "crf" for x, y, k in spans)
        assert found >= (30 if name == "unknown start" else 50), (name, found)
    prose = [" ".join(rng.sample(PROSE.split(), 40)) for _ in range(200)]
    assert sum(bool(tagger.spans(t, g)) for t, g in zip(prose, tagger.tag(prose))) <= 2


def test_tagged_runs_keep_what_base_spans_leave(spark):
    hexed = "0123456789abcdef0123456789"
    text = f"see prefix_{hexed}XYZtail now"
    base = secret_scan.base_spans(text)
    assert base == [(11, 37, "hex")]
    assert secret_scan.beside(4, 44, base) == [(4, 11), (37, 44)]
    assert secret_scan.beside(11, 37, base) == [] and secret_scan.beside(0, 5, base) == [(0, 5)]
    assert secret_scan.beside(2, 9, [(0, 3, "hex"), (5, 6, "hex"), (8, 20, "hex")]) == [(3, 5), (6, 8)]
    tags = np.array([0, 1, 0], dtype=np.int8)
    spans = secret_scan.Tagger(secret_scan.fit([])).spans(text, tags)
    assert spans == [(4, 11, "crf"), (11, 37, "hex"), (37, 44, "crf")]
    made = spark.createDataFrame([(text, [dict(zip(("start", "end", "kind"), s)) for s in spans])], "text string, spans array<struct<start: bigint, end: bigint, kind: string>>")
    assert made.select(secret_scan.redacted(made.text, made.spans, "#").alias("t")).first().t == "see ### now"


def test_training_windows_of_long_settings():
    many = "\n".join(f"token = {k:04d}{'0a1b2c3d' * 4}" for k in range(200))
    windows = secret_scan.training_windows(many)
    assert len(windows) == secret_scan.PER_ROW + 2
    few = secret_scan.training_windows("token = aaaaaa1 and secret: bbbbbb2 and api_key=cccccc3 then passwd = dddddd4, token: eeeeee5")
    assert sum(secret_scan.BEGIN in tags for _, tags, _ in few) >= 5
    assert secret_scan.training_windows("") == []
    copies = secret_scan.varied([w for _, t in secret_docs() for w in secret_scan.training_windows(t)])
    assert copies and all(len(a) == len(b) and secret_scan.BEGIN in b for a, b, _ in copies)


def test_repeated_and_null_ids_give_their_windows_once(spark):
    rows = [(None, t) for _, t in secret_docs()] * 3 + [(7, secret_docs()[0][1])] * 500
    once = secret_scan.learn(frame(spark, [(None, t) for _, t in secret_docs()]), clean_every=2)
    again = secret_scan.learn(frame(spark, rows), clean_every=2)
    assert again.shapes.shape == once.shapes.shape and np.abs(again.shapes - once.shapes).max() < 1.0


def test_viterbi_by_all_paths():
    from itertools import product

    rng = np.random.default_rng(3)
    chains = [rng.normal(size=(n, 3)).astype(np.float32) for n in (0, 1, 5, 3, 6)]
    moves = rng.normal(size=(3, 3)).astype(np.float32)

    def score(e, path):
        return sum(e[i, t] for i, t in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))

    for e, path in zip(chains, secret_scan.viterbi(chains, moves)):
        best = max(product(range(3), repeat=len(e)), key=lambda p: score(e, p))
        assert tuple(path) == best


def test_cutting_chains_changes_no_tag(spark):
    crf = secret_scan.learn(frame(spark, secret_docs()), clean_every=2)
    tagger = secret_scan.Tagger(crf)
    texts = [t for _, t in secret_docs()[:60]] + ["", "token = 9f86d081884c7d659a2feaa0c55ad015 x"] + [t or "" for _, t in AWKWARD]
    scores, of_text = tagger.emissions(texts)
    whole = secret_scan.viterbi([scores[of_text == k] for k in range(len(texts))], crf.moves)
    for a, b in zip(tagger.tag(texts), whole):
        assert a.tolist() == b.tolist()
    assert any(t.any() for t in whole)


def test_expectations_by_all_paths():
    from itertools import product

    rng = np.random.default_rng(5)
    e, moves = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    marginal, pair = secret_scan.expectations(e, moves, np.ones((1, 4), dtype=bool))
    paths = list(product(range(3), repeat=4))
    weight = np.array([np.exp(sum(e[0, i, t] for i, t in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in paths])
    weight /= weight.sum()
    assert np.allclose(marginal[0, 2, 1], sum(w for w, p in zip(weight, paths) if p[2] == 1))
    assert np.allclose(pair[0, 2], sum(w * sum(a == 0 and b == 2 for a, b in zip(p, p[1:])) for w, p in zip(weight, paths)))


def test_redaction_replaces_every_span_once(spark):
    schema = "text string, spans array<struct<start: bigint, end: bigint, kind: string>>"
    rows = [("é123456 z", [(1, 4, "hex"), (3, 6, "hex")]), ("abc", []), ("abc", [(0, 3, "hex")]), ("a b c", [(0, 1, "x"), (4, 5, "x")])]
    df = spark.createDataFrame(rows, schema)
    got = [r.t for r in df.select(secret_scan.redacted(df.text, df.spans, "#").alias("t")).collect()]
    assert got == ["é#6 z", "abc", "#", "# b #"]


ARTICLE = "<h1>Ti&amp;tle</h1><p>One <b>two</b>three\n four.<p>Five &eacute; &#x41;<br>six.</p><ul><li>a<li>b</ul>"
EXPECTED = "Ti&tle\nOne twothree four.\nFive é A six.\na\nb"
BEFORE = "<html><head><title>x</title><style>p{}</style></head><body><nav><ul><li><a href=/>home</a></li></ul></nav><div class='ad'>buy now</div>"
AFTER = "<div id=comments><p>nice text</p></div><footer>&copy; us</footer></body></html>"
PAGES = [
    (f"{BEFORE}<article>{ARTICLE}</article>{AFTER}", EXPECTED),
    (f"{BEFORE}<div class=content>{ARTICLE}</div>{AFTER}", EXPECTED),
    (f"{BEFORE}<article>{ARTICLE}<div class=\"ad box\"><p>ad</div><p>end</article>{AFTER}", EXPECTED + "\nend"),
    (f"{BEFORE}<main><header><h2>Head</h2></header>{ARTICLE}<script>var t='</p>'</script><form><p>mail</form></main>{AFTER}", "Head\n" + EXPECTED),
    (f"{BEFORE}<article>{ARTICLE}", EXPECTED),
    ("", ""), (None, ""), ("<p>", ""), ("no tags at all here", "no tags at all here"), ("<!-- <p>x</p> -->", ""),
]


def test_main_text_of_pages(spark):
    rows = [(k, "u", page, 1) for k, (page, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    for weights in (html_content.DEFAULT, html_content.learn(pages)):
        got = {r.page_id: r for r in html_content.extract_pages(pages, weights).collect()}
        for k, (_, text) in enumerate(PAGES):
            assert got[k].text == text, k
            assert got[k].n_chars == len(text)
    assert html_content.extract_pages(pages.limit(0), html_content.learn(pages.limit(0))).count() == 0


def test_best_region_by_all_regions():
    rng = random.Random(4)
    for _ in range(300):
        scores = np.array([rng.randint(-4, 4) for _ in range(rng.randint(0, 9))], dtype=float)
        a, b = html_content.best_region(scores)
        regions = [scores[i:j].sum() for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert scores[a:b].sum() == max([0, *regions])


def test_deep_and_broken_pages_do_not_fail():
    deep = "<div>" * 3000 + "words in the deep " * 20 + "</div>" * 10
    assert html_content.main_text(deep).startswith("words in the deep")
    for page in ("<", "<<<>>>", "</p></p>", "<a href='", "<script>never ends", "&#xfffffff; &bogus; text"):
        html_content.main_text(page)


def varied_pages(n=60):
    """Pages with one article among menus, adverts, comments and notices; (page, stripped page, text)."""
    rng = random.Random(31)
    made = []
    for k in range(n):
        def prose(low, high, rng=rng):
            return " ".join(rng.choices(PROSE.split(), k=rng.randint(low, high)))

        paragraphs = [prose(8, 60) for _ in range(rng.randint(3, 9))]
        article = f"<h1>{paragraphs[0][:40].strip()}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        menu = "".join(f"<li><a href=/{j}>{w}</a></li>" for j, w in enumerate(rng.sample(PROSE.split(), 6)))
        page = (
            f"<html><head><title>t</title></head><body><nav><ul>{menu}</ul></nav><div class='ad'>{prose(3, 8)}</div>"
            f"<article>{article}</article><div id=comments><p>{prose(3, 10)}</p></div><footer>{prose(3, 8)}</footer></body></html>"
        )
        bare = re.sub(r"<(/?)(article|nav|footer)\b", r"<\1div", page)
        bare = re.sub(r" (class|id)=('[^']*'|\w+)", "", bare)
        made.append((page, bare, "\n".join([paragraphs[0][:40].strip(), *paragraphs])))
    return made


def test_the_scan_decides_where_no_tag_tells(spark):
    pages = varied_pages()
    learned = html_content.learn(spark.createDataFrame([(p,) for p, _, _ in pages], "html string"))
    assert all(html_content.main_text(p, learned) == t for p, _, t in pages)
    # Without the article's tag and without class and id the learned scores find it, equal scores do not.
    right = sum(html_content.main_text(b, learned) == t for _, b, t in pages)
    equal = html_content.Weights({k: 1.0 for k in learned.of})
    assert right >= 0.9 * len(pages)
    assert sum(html_content.main_text(b, equal) == t for _, b, t in pages) <= 0.2 * len(pages)


def test_blocks_that_overlap_the_region_are_whole():
    weights = html_content.Weights({"word": 1.0, "link": -9.0, "never": -4.0, "other": -0.1})
    assert html_content.main_text("<p><a href=x>far away</a> words that stay in the block</p>", weights) == "far away words that stay in the block"


def test_pages_are_read_in_linear_time():
    import time

    n = 100_000
    hard = ["<div>a " * n, "<b>" * n + "x" + "</i>" * n, "<b>" * (n // 2) + "<p>x</p>" * (n // 2), "<tr><table>" + "<b>" * (n // 2) + "<tr></tr>" * (n // 2)]
    begun = time.time()
    for page in hard:
        html_content.main_text(page)
    assert time.time() - begun < 30
