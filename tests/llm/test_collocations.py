"""Collocations against counts of all phrases in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmart.llm.collocations import collocations, frequent_words, number_words, settle, word_blocks, words_of

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, top, least, longest=5):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for y, b in candidates.items():
            for i in range(len(y)):
                for j in range(i + 2, len(y) + 1):
                    x = y[i:j]
                    if len(x) < len(y) and 100 * b >= 100 * candidates[x]:
                        dropped.add(x)
        rows = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def run(spark, docs, **options):
    frame = spark.createDataFrame([(lang, t, 1, "x") for lang, t in docs], "lang string, text string, n long, word string")
    got = collocations(frame.repartition(3), **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def corpus(n, seed, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "日本", "the", "The"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = ["new york city hall", "the the the the the the the", "a b. c d", "rare pair here", "x y z x y z x y z"]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words, weights, k=rng.randrange(8))))
        docs.append((rng.choice(["en", "en", "en", "xx", None, "und", ""]), rng.choice([" ", ". ", "\t", "\n", " ", "  ,"]).join(parts)))
    return docs


@pytest.mark.parametrize(("top", "least", "wave"), [(2000, 8, 0.5), (5, 8, 0.05), (12, 3, 0.3), (1, 20, 0.0)])
def test_against_all_phrases(spark, top, least, wave):
    docs = corpus(500, seed=top) + [(None, None), ("en", ""), ("en", " \t.;")]
    got = run(spark, docs, top=top, least=least, first_wave=wave)
    assert got == brute(docs, top, least)
    assert {lang for lang, *_ in got} == {"en", "xx", "und", ""}


def test_ties_at_the_last_place_and_equal_rows(spark):
    docs = [("en", f"a{i % 7} b{i % 7}. filler") for i in range(70)] * 2
    assert run(spark, docs, top=4, least=5) == brute(docs, 4, 5)
    assert len(brute(docs, 4, 5)) == 4


def test_shorter_pieces_and_lengths(spark):
    docs = corpus(200, seed=9)
    for longest in (2, 3, 6):
        assert run(spark, docs, top=50, least=5, longest=longest) == brute(docs, 50, 5, longest)


@pytest.mark.parametrize("docs", [[], [(None, None)], [("en", "one two three")], [("en", "?!")]])
def test_no_phrases(spark, docs):
    assert run(spark, docs) == []


def test_scores_beyond_64_bits(spark):
    big = 10**15
    words = spark.createDataFrame([("en", "u", big + 7, 1), ("en", "v", big + 1, 2)], "lang string, word string, f long, id long")
    phrases = spark.createDataFrame([((1 << 32) | 2, 0, 0, 2, big - 3, "en", big + 7, big + 1)], "k1 long, k2 long, k3 long, length int, a long, lang string, first_f long, last_f long")
    totals = spark.createDataFrame([("en", 31 * big + 11)], "lang string, n long")
    upto = spark.createDataFrame([("en", 2 * big)], "lang string, upto long")
    row = settle(phrases, words, totals, upto).collect()[0]
    assert row["score"] == 1000 * (big - 3) * (31 * big + 11) // ((big + 7) * (big + 1))


def test_words_of_a_text():
    words, codes = words_of("Ab cD\tab. é?É ab\n\nAB".encode())
    names = [None, *words.to_pylist()]
    assert [names[c] for c in codes] == ["ab", "cd", "ab", None, "é", None, "É", "ab", None, "ab"]


def test_very_long_text_in_blocks(spark):
    text = "alpha beta gamma. delta alpha beta\n" * 150_000
    assert len(text) > 4 * 1024 * 1024
    assert run(spark, [("en", text)]) == brute([("en", text)], 2000, 100)


def test_words_are_numbered_alike_whether_broadcast_or_shuffled(spark):
    docs = spark.createDataFrame(corpus(300, seed=2), "lang string, text string").repartition(4)
    blocks = word_blocks(docs)
    counts = blocks.select("lang", F.explode(F.arrays_zip("words", "times")).alias("x")).groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.times").alias("f"))
    words = frequent_words(counts, 5)
    assert sorted(r["id"] for r in words.collect()) == list(range(1, words.count() + 1))
    spelled = []
    for bound in (1 << 25, 0):
        name = {r["id"]: (r["word"], r["f"]) for r in words.collect()}
        found = []
        for r in number_words(blocks, words, bound).collect():
            ids, f = np.frombuffer(r["ids"], "<u4").tolist(), np.frombuffer(r["f"], "<i8").tolist()
            assert all(name[i][1] == n for i, n in zip(ids[1:], f[1:]))
            found.append((r["lang"], [name[ids[c]][0] if c else None for c in np.frombuffer(r["codes"], "<u2").tolist()]))
        spelled.append(sorted(map(repr, found)))
    assert spelled[0] == spelled[1]
