"""Token alignment against whole texts encoded by the libraries and bytes compared one by one."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tillmart.llm.alignment import BLOCK_BYTES, align_blocks, align_tokens, overlaps, pair_counts

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  ", "a", " a ", "two  blanks\tand\n\nlines \n", "a <|endoftext|> b</s> <s><unk>", "x ▁ y", "▁", "é ñ ü ß 漢字 🙂🙂 ﬁ ½ \u0000 end",
    "don't   stop 12,345.67 -- ok...", "<0x41>   wide　blank", "copy of this", "copy of this", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa bbbb",
]


def byte_of_letter():
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in seen}, 0
    for b in range(256):
        if b not in seen:
            out[chr(256 + n)] = b
            n += 1
    return out


def brute(texts):
    """(links, groups, n_a, n_b) of each text, or None."""
    a_side, b_side, letter = Tokenizer.from_file(BYTE_BPE), SentencePieceProcessor(model_file=PIECES), byte_of_letter()
    a_side.encode_special_tokens = True
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        a = a_side.encode(" " + text, add_special_tokens=False).ids
        b = b_side.encode(text)
        a_bytes = [bytes(letter[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([i - 3]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out.append(None)
            continue
        of_a = [k for k, x in enumerate(a_bytes) for _ in x]
        of_b = [k for k, x in enumerate(b_bytes) for _ in x]
        links = sorted({*zip(of_a, of_b)})
        groups = None
        if len(a) < 100_000:
            groups, begin = [], 0
            for end in sorted({*accumulate(map(len, a_bytes))} & {*accumulate(map(len, b_bytes))}):
                groups.append("|".join(",".join(str(side[i]) for i in sorted({*of[begin:end]})) for side, of in ((a, of_a), (b, of_b))))
                begin = end
        out.append(([(a[i], b[j]) for i, j in links], groups, len(a), len(b)))
    return out


def expected(ids, texts):
    found = brute(texts)
    count = Counter(pair for x in found if x for pair in x[0])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    rows = []
    for doc_id, x in zip(ids, found):
        if x is None:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links, groups, n_a, n_b = x
        rows.append((
            doc_id, n_a, n_b, len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    return rows


def texts_of(n, seed=5):
    rng = random.Random(seed)
    signs = ["the", "Token", "ñandú", "word", "ing", " ", "  ", "\n", ",", "3.14", "über", "漢", "🙂", "'s", "-", "\t", "▁"]
    return ["".join(rng.choices(signs, weights=[9] * 5 + [20] + [2] * 10 + [0.05], k=rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("pair_table_bytes", [1 << 25, 0])
def test_against_whole_texts(spark, pair_table_bytes):
    texts = ODD + texts_of(120)
    ids = [None, 1, 1, *range(3, len(texts))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], "doc_id long, text string, row string, block int")
    got = align_tokens(docs.repartition(3), BYTE_BPE, PIECES, pair_table_bytes=pair_table_bytes)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(ids, texts), key=repr)


def test_groups_as_text_and_counts_of_pairs(spark):
    docs = spark.createDataFrame([("k1", "one two"), ("k2", None), ("k3", "two one")], "doc_id string, text string")
    for r in align_tokens(docs, BYTE_BPE, PIECES, keep_groups=True).collect():
        assert r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")
        assert r["groups"].count(";") + bool(r["groups"]) == r["n_groups"]
    found = brute(["one two", "two one"])
    count = Counter(pair for x in found for pair in x[0])
    got = pair_counts(align_blocks(docs, BYTE_BPE, PIECES)).collect()
    assert {(r["a_id"], r["b_id"]): r["times"] for r in got} == dict(count)
    assert all(r["best"] == (r["times"] == max(n for (_, b), n in count.items() if b == r["b_id"])) for r in got)


def test_very_long_text_in_parts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) for _ in range(500)]
    text = " ".join(rng.choices(words, k=3 * BLOCK_BYTES // 5))
    assert len(text) > 2 * BLOCK_BYTES
    docs = spark.createDataFrame([(1, text), (2, text + " ▁"), (3, "short")], "doc_id long, text string")
    assert align_blocks(docs.where("doc_id = 1"), BYTE_BPE, PIECES).count() > 1
    got = {r["doc_id"]: r for r in align_tokens(docs, BYTE_BPE, PIECES, keep_groups=True).collect()}
    links, _, n_a, n_b = brute([text])[0]
    assert (got[1]["n_a"], got[1]["n_b"], got[1]["n_links"]) == (n_a, n_b, len(links))
    assert got[1]["groups_sha256"] == hashlib.sha256(got[1]["groups"].encode()).hexdigest()
    assert [int(i) for g in got[1]["groups"].split(";") for i in g.split("|")[0].split(",")] == Tokenizer.from_file(BYTE_BPE).encode(" " + text).ids
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", "")


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokens(empty, BYTE_BPE, PIECES).collect() == []
    assert align_tokens(empty, BYTE_BPE, PIECES, pair_table_bytes=-1).collect() == []


def test_links_of_bytes():
    #   A: [ab][c][d]   B: [a][bc][d]
    links = overlaps(np.zeros(3, int), np.array([2, 3, 4]), np.zeros(3, int), np.array([1, 3, 4]))
    assert sorted(zip(links.a.tolist(), links.b.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2)]
    assert (links.a_last.tolist(), links.b_last.tolist()) == ([1, 2], [1, 2])
