import random
import re

import numpy as np
import pytest
import xxhash

from tillmart.llm.near_duplicates import components, fingerprint, keep_one, near_duplicate_groups, simhash_components, spanning_links


def plain_print(text):
    w = [x for x in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return 0
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, distance=3):
    fps, root = list(fps), {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def sample_texts():
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(300)]
    texts = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 5, 60, 400]))) for _ in range(60)]
    for base in texts[:20]:
        words = base.split()
        for _ in range(4):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
    return [None, "", " \n\t", "!", "A\x0bB\x0cC d", "x y", "a b c d"] + texts + texts[:9] + [texts[5].upper()]


def test_fingerprint():
    for text in sample_texts():
        assert fingerprint(text) == plain_print(text)


@pytest.mark.parametrize("bucket_rows", [1 << 16, 3])
def test_components_against_brute_force(spark, bucket_rows):
    rows = [(i if i % 11 else None, t, "z") for i, t in enumerate(sample_texts())] + [(3, "x y", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    prints = {t: plain_print(t) for _, t, _ in rows}
    group = brute_groups(set(prints.values()))
    least = {}
    for doc_id, text, _ in rows:
        root = group[prints[text]]
        least[root] = min([x for x in (least.get(root), doc_id) if x is not None], default=None)
    want = sorted([(d, f"{prints[t]:016x}", least[group[prints[t]]]) for d, t, _ in rows], key=repr)
    got = sorted([tuple(r) for r in simhash_components(docs, bucket_rows=bucket_rows).collect()], key=repr)
    assert got == want
    kept = keep_one(docs, bucket_rows=bucket_rows, broadcast_bytes=0 if bucket_rows == 3 else 1 << 20)
    assert kept.columns == docs.columns
    ids = sorted([r["doc_id"] for r in kept.collect()], key=repr)
    assert ids == sorted(least.values(), key=repr)


@pytest.mark.parametrize("bucket_rows, batch", [(1 << 16, 2000), (1 << 16, 7), (20, 7)])
def test_dense_and_chained_fingerprints(spark, bucket_rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    rng = np.random.default_rng(5)
    fps = set()
    for _ in range(5):
        at = int(rng.integers(0, 1 << 63))
        for _ in range(40):
            at ^= 1 << int(rng.integers(0, 64)) ^ 0
            fps.add(at)
        for _ in range(20):
            fps.add(at ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    fps |= {0, 1, 3, (1 << 64) - 1}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    found = near_duplicate_groups(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket_rows=bucket_rows).collect()
    want = brute_groups(fps)
    roots, seen = {}, {}
    for r in found:
        roots[r["fp"] % (1 << 64)] = r["root"]
    assert len(roots) == len(fps)
    for f, root in want.items():
        assert seen.setdefault(root, roots[f]) == roots[f]
    assert len(set(seen.values())) == len(seen)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_spanning_links():
    fps = np.array([0, 1, 3, 7, 15, 31, 3 << 40, (3 << 40) + 1], np.uint64)
    a, b = spanning_links(fps, 1)
    assert len(a) == 6 and (np.bitwise_count(a ^ b) == 1).all()


def test_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 999)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 999: 999, 1000: 999}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert simhash_components(docs).collect() == [] and keep_one(docs).collect() == []
