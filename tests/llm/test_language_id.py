import random
import re
import zlib

import numpy as np

from tillmart.llm.language_id import (
    FEWEST_BACKWARDS,
    backwards,
    identify,
    keep_identified,
    learn,
    learn_bounded,
    order_bounds,
    phrases,
    predict_languages,
    suffix_automaton,
    train,
    training_sample,
)


def brute_phrases(text, corpus, block=1024):
    n = 0
    for a in range(0, len(text), block):
        part, i = text[a:a + block], 0
        while i < len(part):
            j = i + 1
            while j < len(part) and part[i:j + 1] in corpus:
                j += 1
            n, i = n + 1, j
    return n


def test_automaton_accepts_substrings_only():
    rng = random.Random(1)
    codes = [rng.randrange(3) for _ in range(200)]
    to = suffix_automaton(codes, 3)
    for _ in range(2000):
        word = [rng.randrange(3) for _ in range(rng.randint(1, 9))]
        state = 0
        for c in word:
            state = to[state, c] if state >= 0 else -1
        inside = any(codes[i:i + len(word)] == word for i in range(len(codes)))
        assert (state >= 0) == inside


def test_phrases_against_brute_force():
    rng = random.Random(2)
    corpora = {"x": "".join(rng.choices("abcd ", k=500)), "y": "".join(rng.choices("cdef ", k=500))}
    corpora["x"] += "ÉÈ हिन्दी"
    model = train({k: [v] for k, v in corpora.items()})
    plain = lambda t: re.sub("[^a-zéèहिन्दी]+", " ", t.lower())
    corpora = {k: plain(v) for k, v in corpora.items()}
    texts = ["", "a", "zzz", "ABCD"] + ["".join(rng.choices("abcdefz ", k=rng.randint(1, 60))) for _ in range(80)] + ["abc def " * 400, "  !!a%% %%B!  ", "1234", "é हिन् x"]
    for block in (1024, 7):
        got = phrases(texts, model, block)
        want = [[brute_phrases(plain(t), corpora[k], block) for k in "xy"] for t in texts]
        # Letters that no language has share a class of their own, which no corpus holds.
        assert np.array_equal(got, want)


def words(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


def test_languages(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        lang = "aa" if i % 3 else "bb"
        rows.append((i, words(rng, "etaoin shr" if lang == "aa" else "uüöäßkzwe", 40), lang, 1.0))
    rows += [(300, None, "aa", 1.0), (301, "", "aa", 1.0), (302, "123 !!", "bb", 1.0), (None, "etaoin", "aa", 1.0), (303, "etaoin " * 30000, None, 1.0), (0, rows[0][1], "bb", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(3)
    out = predict_languages(docs).collect()
    assert len(out) == len(rows)
    truth = {r[0]: r[2] for r in rows[:300]}
    for r in out:
        if r["doc_id"] in (300, 301, 302):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] in truth:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
            assert r["lang_pred"] == truth[r["doc_id"]] and 0.5 <= r["score"] <= 1
        else:
            assert r["lang_pred"] == "aa" and not r["held_out"] or r["doc_id"] == 303


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rng = random.Random(5)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, words(rng, "abcdef", 20), "aa") for i in range(400) if i not in held] + [(i, words(rng, "uvwxyz", 20), "zz") for i in held]
    assert learn(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == ["aa"]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert predict_languages(docs).collect() == []
    only = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in predict_languages(only).collect()] == ["und"]
    assert identify(only.select("text"), train({"q": ["abc"]})).collect()[0]["lang_pred"] == "q"


def test_letters_of_many_scripts_are_told_apart(spark):
    rng = random.Random(7)
    latin, cyrillic = "abcdefghijklmnopqrstuvwxyzàâçèéêëîïôùûœßäöüñ", "абвгдежзийклмнопрстуфхцчшщъыьэюя"
    han = [chr(0x4E00 + i) for i in range(3000)]
    pools = {"la": latin, "ru": cyrillic, "bg": cyrillic, "zh": han, "ja": han}
    vocab = {lang: ["".join(rng.choices(pool, k=rng.randint(2, 4))) for _ in range(700)] for lang, pool in pools.items()}
    text = lambda lang, n: ("" if lang in ("zh", "ja") else " ").join(rng.choices(vocab[lang], k=n))
    model = train({lang: [text(lang, 1500) for _ in range(5 if lang == "la" else 2)] for lang in pools})
    assert model.languages == sorted(pools)
    asked = [(lang, text(lang, 60)) for lang in pools for _ in range(5)]
    out = identify(spark.createDataFrame(asked, "lang string, text string"), model).collect()
    assert len(out) == 25 and all(r["lang_pred"] == r["lang"] and r["score"] > 0.5 for r in out)
    # Letters that no sample has are phrases of one character.
    assert phrases(["жжжж" * 10 + "ΩΩΩ"], train({"x": ["abc"]})).tolist() == [[43]]


def test_sample_of_copies_is_neither_empty_nor_one_text(spark):
    rng = random.Random(9)
    texts = [words(rng, "abcdefgh", 400)[:1500] for _ in range(20)]
    rows = [(i, texts[i % 20], "aa") for i in range(3000)] + [(i, texts[0][:700] + " x", "bb") for i in range(3000)]
    rows += [(0, "k" * 3000 + "l" * 3000 + "m" * 3000, "long"), (1, None, "aa"), (2, " ", "none"), (3, "z", None)]
    labelled = spark.createDataFrame(rows, "n long, text string, lang string").repartition(5)
    got = training_sample(labelled, sample_chars=6000)
    assert sorted(got) == ["aa", "bb", "long"]
    assert len(got["aa"]) == len(set(got["aa"])) == 4 and len(got["bb"]) == 1
    assert len(got["long"][0]) <= 2003 and min(got["long"][0].count(c) for c in "klm") >= 500
    assert training_sample(labelled, sample_chars=6000) == got
    assert learn(spark.createDataFrame([(i, texts[0], "aa") for i in range(300)], "doc_id long, text string, lang string"), 10).languages == ["aa"]


def test_letters_in_no_learned_order_are_rejected(spark):
    rng = random.Random(11)
    vocab = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(300)] for lang, letters in (("aa", "abcdefghi"), ("bb", "defghijklm"))}
    text = lambda lang, n: " ".join(rng.choices(vocab[lang], k=n))
    noise = lambda n: "".join(rng.choices("abcdefghijklm   ", k=n))
    rows = [(i, text(lang, 150), lang, i, "x") for i, lang in enumerate(["aa", "bb"] * 90)]
    rows += [(1000 + i, noise(600), None, i, "x") for i in range(8)] + [(2000, noise(8), None, 0, "x"), (2001, "хорошая погода " * 30, None, 0, "x")]
    rows += [(2002, None, "aa", 0, "x"), (2003, "12 34", "aa", 0, "x"), (None, text("bb", 80), None, None, None), (0, rows[0][1], "aa", 0, "x"), (2004, text("aa", 4000), None, 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score long, lang_pred string").repartition(4)
    model, bounds = learn_bounded(docs)
    assert model.languages == ["aa", "bb"] and (bounds > 0.5).all() and (bounds < 1).all()
    kept = keep_identified(docs)
    assert kept.columns == docs.columns
    strange = {*range(1000, 1008), 2001, 2002, 2003}
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if r["doc_id"] not in strange)
    assert {r["doc_id"] for r in keep_identified(docs, accepted=["bb"]).collect()} <= {r[0] for r in rows if r[2] != "aa"}


def test_bounds_of_orders():
    rng = random.Random(12)
    vocab = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(200)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    model = train({"x": [text(3000)], "y": ["zyxw " * 50]})
    own = [text(100) for _ in range(9)]
    need = phrases(own, model)
    back = backwards(own, model, need)
    assert back.tolist() == [phrases([t[::-1]], model)[0, 0] for t in own] and (back > need[:, 0]).all()
    bounds = order_bounds({"x": own, "y": ["zy"]}, model)
    assert bounds[0] == (2 + np.median(need[:, 0] / back)) / 3 and bounds[1] == np.inf
    assert order_bounds({}, model).tolist() == [np.inf, np.inf] and FEWEST_BACKWARDS > 1
