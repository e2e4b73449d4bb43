"""Toxicity, token counts, pseudo-likelihood and quality rules."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, PROSE, WORD, frame
from pyspark.sql import functions as F

from tallyworks.llm import bpe_counts, pseudo_likelihood, quality_rules, toxicity, words
from tallyworks.llm.queries import vocabulary

BAD = ["blortish", "grumpfer", "snivelot"]


def labelled(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for k in range(400):
        text = rng.sample(PROSE.split(), 25)
        toxic = k % 4 == 0
        if toxic:
            text[3] = rng.choice(BAD)
            text[9] = rng.choice(BAD)
        docs.append((k, " ".join(text)))
        labels.append((k, int(k % 5 > 0), int(toxic)))
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_fold_undoes_disguises():
    assert toxicity.fold("GRUMPFER") == "grumpfer"
    assert toxicity.fold("grumрfеr") == "grumpfer"  # Cyrillic letters
    assert toxicity.fold("gr​umpfer $nivelot bl0rt1sh") == "grumpfer snivelot blortish"
    assert toxicity.fold("a 1990 b## thoner$$$") == "a 1990 b## thoner$$$"


def test_lexicon_is_learned_and_marks_held_out_rows(spark):
    docs, labels = labelled(spark)
    lexicon = toxicity.learn(docs, labels)
    assert all(any(w.strip() in b or b.startswith(w.strip()) for b in BAD) for w in list(lexicon.weights)[:3])
    scored = toxicity.score_documents(docs, lexicon).join(labels, "doc_id").where("held_out").collect()
    assert scored and all(r.predicted == r.toxic for r in scored)
    extra = frame(spark, [(1, "what a gru­mpf3r"), (2, f"{PROSE} {PROSE}")])
    assert [r.predicted for r in toxicity.score_documents(extra, lexicon).orderBy("doc_id").collect()] == [1, 0]


def test_signs_beside_each_other_are_undone():
    lexicon = toxicity.Lexicon({"ass ": 2.0, "idiot ": 3.0, "thoner ": 1.0, "blor": 2.5})
    for text, weight in (("a$$", 2.0), ("1d!0t", 3.0), ("1D10T!", 3.0), ("thoner$$$", 1.0), ("b|0rt!$h", 0.0), ("bl0rt!$h", 2.5), ("pass! as!", 0.0), ("costs 5$ or $10!", 0.0)):
        assert sum(w for w, _ in lexicon.hits(text)[0].values()) == weight, text
    assert toxicity.fold("1d!0t") == "idiot" and toxicity.fold("thoner$$$") == "thoner$$$"


def naive_hits(lexicon, text):
    """Every entry tried at every word, exceptions by plain search."""
    found = lexicon.hits(text)[1]  # the folded words, joined by blanks
    best, covered = {}, []
    for start in range(1, len(found)):
        if found[start - 1] != " ":
            continue
        held = [w for e, w in lexicon.weights.items() if found.startswith(e, start)]
        if held:
            best[start] = max(held)
        covered += [(start, start + len(p)) for p in lexicon.exceptions if found.startswith(f"{p} ", start)]
    return {s: w for s, w in best.items() if not any(a <= s < b for a, b in covered)}


def test_automaton_equals_a_naive_matcher():
    rng = random.Random(9)
    parts = ["blor", "tish", "grum", "pfer", "river", "the", "mill", "sn", "ivel"]
    words_made = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(60)]
    for _ in range(60):
        entries = {w + " ": rng.random() for w in rng.sample(words_made, 12)} | {w[: rng.randint(4, 8)]: rng.random() for w in rng.sample(words_made, 8)}
        phrases = tuple(" ".join(rng.choices(words_made, k=2)) for _ in range(10))
        lexicon = toxicity.Lexicon(entries, phrases)
        text = " ".join(rng.choices([*words_made, "gr!m", "bl0rt1sh", "RIVER!", "x"], k=80))
        assert {s: w for s, (w, _) in lexicon.hits(text)[0].items()} == naive_hits(lexicon, text)


def test_exception_phrases_cancel_entries():
    lexicon = toxicity.Lexicon({"trash ": 5.0}, ("trash can",), -3.0, (1.0, 1.0))
    assert lexicon.score("a trash can stood there") < 0.5 < lexicon.score("you trash there")
    assert lexicon.score("trashy") < 0.5


def test_scores_of_awkward_rows(spark):
    docs, labels = labelled(spark)
    lexicon = toxicity.learn(docs, labels)
    rows = toxicity.score_documents(frame(spark, AWKWARD), lexicon).collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score_documents(frame(spark, []), lexicon).count() == 0
    nothing = toxicity.learn(frame(spark, []), labels)
    assert toxicity.score_documents(frame(spark, AWKWARD), nothing).count() == len(AWKWARD)


def test_token_counts_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("word_bpe_49k.json")
    coder = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(3)
    letters = [*"aAbZéÉΣσςİß 's'll\t\n\x0b\x1c\x1f\x85  ٣½Ⅷ１日本\U0001f600_-.!<|>", "<|endoftext|>", "the", "<|ENDOFTEXT|>"]
    made = [(1000 + k, "".join(rng.choices(letters, k=rng.randint(0, 30)))) for k in range(500)]
    rows = bpe_counts.count_tokens(frame(spark, AWKWARD + made), path).collect()
    expected = sorted(
        (len((t or "").encode()), len(coder.encode(t or "", add_special_tokens=False).ids)) for _, t in AWKWARD + made
    )
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == expected
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
    assert bpe_counts.count_tokens(frame(spark, []), path).count() == 0


def test_merges_take_the_lowest_rank_from_the_left():
    ranks = {("a", "a"): 0, ("aa", "a"): 1, ("aa", "aa"): 2}
    assert bpe_counts.merge_count(list("aaaa"), ranks) == 3
    assert bpe_counts.merge_count(list("aaaaa"), ranks) == 3  # aa aa a: the pair aa-a ranks before aa-aa
    assert bpe_counts.merge_count([], ranks) == bpe_counts.merge_count(["b"], ranks) == 0


def test_pseudo_likelihood_prefers_what_it_has_seen(spark):
    rng = random.Random(1)
    usual = [(k, " ".join(PROSE.split()[rng.randint(0, 20) :])) for k in range(300)]
    shuffled = [(k, " ".join(rng.sample(t.split(), len(t.split())))) for k, t in usual]
    model = pseudo_likelihood.learn(frame(spark, usual * 4))
    a = pseudo_likelihood.score_documents(frame(spark, usual), model).agg({"mean_log": "avg"}).first()[0]
    b = pseudo_likelihood.score_documents(frame(spark, shuffled), model).agg({"mean_log": "avg"}).first()[0]
    assert a > b


def test_pseudo_likelihood_gradient_and_awkward_rows(spark):
    network = pseudo_likelihood.Network.random(2)
    flat, at, counts = pseudo_likelihood.laid_out(["a b c", None, "", "d e"], pseudo_likelihood.Vocabulary({"a": 0, "d": 40}))
    assert counts.tolist() == [3, 0, 0, 2] and len(at) == 5
    before = network.forward(flat, at)[0].mean()
    for _ in range(20):
        network.step(flat, at, 0.1)
    after = network.forward(flat, at)[0]
    assert before < after.mean() < 0
    # Probabilities over the whole vocabulary add up to one.
    total = 0.0
    for word in range(pseudo_likelihood.PAD):
        changed = flat.copy()
        changed[at[1]] = word
        total += np.exp(network.forward(changed, at[1:2])[0][0])
    assert abs(total - 1) < 1e-3
    model = pseudo_likelihood.learn(frame(spark, AWKWARD))
    rows = pseudo_likelihood.score_documents(frame(spark, AWKWARD), model).collect()
    assert len(rows) == len(AWKWARD)
    assert all((r.n_words == 0) == (r.mean_log is None) for r in rows)
    empty = pseudo_likelihood.learn(frame(spark, []))
    assert pseudo_likelihood.score_documents(frame(spark, []), empty).count() == 0


def test_gradients_by_small_differences():
    rng = np.random.default_rng(5)
    network = pseudo_likelihood.Network.random(3, 8)
    flat = rng.integers(0, 64, 60)
    at = np.arange(2, 58)
    fixed = pseudo_likelihood.Network.of_vector(network.vector(), 8).fixed()
    assert np.allclose(fixed.log_probability(flat, at), network.forward(flat, at)[0], atol=1e-5)
    before = {k: v.astype(np.float64) for k, v in network.w.items()}
    network.squares = {k: np.full(v.shape, 1.0, dtype=np.float32) for k, v in network.w.items()}
    stepped = pseudo_likelihood.Network.of_vector(network.vector(), 8)
    stepped.squares = {k: np.full(v.shape, 1e12, dtype=np.float32) for k, v in network.w.items()}
    stepped.step(flat, at, 1e8)  # so large a start of the squares leaves the gradient itself, times 100
    for name, weights in before.items():
        for place in rng.integers(0, weights.size, 12):
            means = []
            for change in (0.01, -0.01):
                moved = {k: v.copy() for k, v in before.items()}
                moved[name].ravel()[place] += change
                tried = pseudo_likelihood.Network({k: v.astype(np.float64) for k, v in moved.items()})
                means.append(tried.forward(flat, at)[0].mean(dtype=np.float64))
            expected = (means[0] - means[1]) / 0.02
            got = (stepped.w[name].ravel()[place] - weights.ravel()[place]) / 100
            assert abs(got - expected) < 2e-4 + 0.05 * abs(expected), (name, place)


def test_scores_do_not_depend_on_files(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "SHARE", 3000)
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choices(PROSE.split(), k=60))) for k in range(150)]
    rows += [(None, PROSE), (3, PROSE), (3, PROSE)]
    scores = []
    for parts in (1, 13):
        docs = frame(spark, rows).repartition(parts, "doc_id", "text") if parts > 1 else frame(spark, rows).coalesce(1)
        got = pseudo_likelihood.score_documents(docs, pseudo_likelihood.learn(docs)).collect()
        scores.append(sorted((str(r.doc_id), r.n_words, round(r.log_likelihood, 2)) for r in got))
    assert scores[0] == scores[1]


def test_every_word_has_a_probability_of_its_own(spark, monkeypatch):
    """Words of one bucket differ by their share of it, and a bucket's words share all of it."""
    monkeypatch.setattr(pseudo_likelihood, "MOST_HOT", 2500)
    # Two words of one bucket; 768 words are predicted by themselves.
    usual = [(k, " ".join(f"w{j}" for j in range(1000))) for k in range(3)]
    rare = [(10, " ".join(f"r{j}" for j in range(2000))), (11, "aaxyz bbxyz bbxyz é漢字")]
    docs = frame(spark, usual + rare)
    model = pseudo_likelihood.learn(docs)
    counts = Counter(t for _, text in usual + rare for t in text.split())
    assert {r.word: r.n for r in model[0].counts.collect()} == counts
    texts = {1: "aaxyz", 2: "bbxyz", 4: "qqxyz", 5: "w1 aaxyz w2", 6: "w1 bbxyz w2"}
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.score_documents(frame(spark, [*texts.items()]), model).collect()}
    assert abs(got[2] - got[1] - np.log(2)) < 1e-6
    assert abs(got[6] - got[5] - np.log(2)) < 1e-6
    in_bucket = sum(n for w, n in counts.items() if w not in model[0].known and pseudo_likelihood.bucket(w) == pseudo_likelihood.bucket("aaxyz"))
    assert abs(got[2] - got[4] - np.log(2 * (in_bucket + 1) / in_bucket)) < 1e-6
    # The bucket's own log-probability plus the share, for every word of a document.
    network = pseudo_likelihood.Network.of_vector(model[1], model[0].side)
    for text in (*texts.values(), rare[1][1], usual[0][1]):
        flat, at, _ = pseudo_likelihood.laid_out([text], model[0])
        expected = float(network.forward(flat, at)[0].sum())
        for w in text.split():
            if w not in model[0].known:
                total = sum(n for x, n in counts.items() if x not in model[0].known and pseudo_likelihood.bucket(x) == pseudo_likelihood.bucket(w))
                expected += np.log(counts[w] / total if w in counts else 1 / (total + 1))
        one = pseudo_likelihood.score_documents(frame(spark, [(1, text)]), model).first()
        assert abs(one.log_likelihood - expected) < 1e-3


def test_words_predicted_by_themselves_grow_with_the_corpus(spark):
    few = " ".join(f"w{j}" for j in range(900))
    small = pseudo_likelihood.learn_vocabulary(frame(spark, [(1, few)]))
    large = pseudo_likelihood.learn_vocabulary(frame(spark, [(k, few) for k in range(900)]))
    assert (small.side, len(small.known)) == (32, 768)
    assert large.side == 40 and len(large.known) == 900
    network = pseudo_likelihood.Network.random(3, large.side)
    flat, at, _ = pseudo_likelihood.laid_out(["w1 w2 zz"], large)
    total = 0.0
    for entry in range(large.pad):
        changed = flat.copy()
        changed[at[1]] = entry
        total += np.exp(network.forward(changed, at[1:2])[0][0])
    assert abs(total - 1) < 1e-3


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_statistics_by_brute_force(spark):
    made = [(50, "a b c a b c x\n\n a \n a \n #*| <x>"), (51, "aaa " * 7), (52, "p q\np q\np q"), (53, "a\x0bb\x1cc d")]
    rows = AWKWARD + made
    got = quality_rules.judge_documents(frame(spark, rows), []).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(brute_counts(t) for _, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
    assert quality_rules.judge_documents(frame(spark, []), []).count() == 0


def test_rules_find_a_planted_conjunction(spark):
    rng = np.random.default_rng(4)
    x = rng.random((900, len(quality_rules.FEATURES)))
    bad = (x[:, 2] >= 0.7) & (x[:, 4] <= 0.4)
    rules = quality_rules.learn_rules(x, bad)
    caught = np.zeros(len(x), dtype=bool)
    for rule in rules:
        caught |= rule.covers(x)
    assert (caught == bad).mean() > 0.97
    values = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], list(quality_rules.FEATURES))
    kept = [r.kept for r in values.select(quality_rules.verdict(rules).alias("kept")).collect()]
    assert kept == [not c for c in caught[:50]]
    assert quality_rules.learn_rules(np.empty((0, len(quality_rules.FEATURES))), np.empty(0, dtype=bool)) == []


def plain_gains(x, bad, inside, cuts):
    """The information gain of every condition there is, each counted row by row."""
    rows = [(r, b) for r, b, i in zip(x.tolist(), bad.tolist(), inside.tolist()) if i]
    p = sum(b for _, b in rows)
    gains = {}
    for j, name in enumerate(quality_rules.FEATURES):
        for cut in cuts[j].tolist():
            for at_least in (True, False):
                met = [b for r, b in rows if (r[j] >= cut if at_least else r[j] <= cut)]
                hits = sum(met)
                gain = hits * (math.log2(hits / len(met)) - math.log2(p / len(rows))) if hits else -math.inf
                gains[quality_rules.Condition(name, at_least, cut)] = gain
    return gains


@pytest.mark.parametrize("seed", range(4))
def test_covering_by_brute_force(seed):
    """Every step of the covering is the best one; values with many ties, labels with noise."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 7, (240, len(quality_rules.FEATURES))).astype(float)
    bad = ((x[:, 1] >= 5) & (x[:, 3] <= 3)) | (x[:, 8] == 0) ^ (rng.random(240) < 0.04)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 200))) for j in range(x.shape[1])]
    rules = quality_rules.learn_rules(x, bad)
    assert rules
    left, third = np.ones(240, dtype=bool), np.arange(240) % 3 == 2
    for rule in [*rules, None]:
        grown = quality_rules.grow(x[left & ~third], bad[left & ~third], cuts, 4)
        inside = left & ~third
        for condition in grown:
            gains = plain_gains(x, bad, inside, cuts)
            assert gains[condition] == pytest.approx(max(gains.values())) and gains[condition] > 0
            inside &= condition.compare(x[:, quality_rules.FEATURES.index(condition.feature)])
        pure = not (inside & ~bad).any() or not (inside & bad).any()
        assert pure or len(grown) == 4 or max(plain_gains(x, bad, inside, cuts).values()) <= 1e-9

        def worth(conditions):
            met = [b for r, b in zip(x[left & third], bad[left & third])
                   if all(c.compare(r[quality_rules.FEATURES.index(c.feature)]) for c in conditions)]
            return (2 * sum(met) - len(met)) / (len(met) + 1)

        starts = [grown[:k] for k in range(1, len(grown) + 1)]
        best = max(map(worth, starts)) if starts else None
        chosen = next((c for c in starts if worth(c) == best), [])
        met = quality_rules.Rule(tuple(chosen)).covers(x) & left
        good_enough = bool(chosen) and met.sum() >= 4 and (met & bad).sum() >= 0.8 * met.sum()
        if rule is None:
            assert len(rules) == 12 or (left & bad).sum() < 4 or not good_enough
        else:
            assert list(rule.conditions) == chosen and good_enough
            left &= ~met


def test_rules_from_tables(spark):
    docs, labels = labelled(spark)
    assert isinstance(quality_rules.learn(docs, labels), list)
    assert quality_rules.learn(frame(spark, []), labels) == []
    assert str(quality_rules.Rule((quality_rules.Condition("n_words", True, 3.0),))) == "n_words >= 3"


def test_held_out_is_one_in_five(spark):
    rows = spark.range(200).select("id", words.held_out(F.col("id")).alias("x")).collect()
    assert all(r.x == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
