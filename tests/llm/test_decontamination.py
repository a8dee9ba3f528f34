import hashlib
import re

import pytest

from tillmart.llm.decontamination import find_passages, judge_passages

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for item_id, passage in items:
            q = words(passage)
            n = min(window, len(q))
            for i in range(len(q) - n + 1 if q else 0):
                for s in range(len(w) - n + 1):
                    if w[s:s + n] == q[i:i + n]:
                        hit |= set(range(s, s + n))
                        if item_id is not None:
                            ids.add(str(item_id))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


PASSAGE = " ".join(f"w{i % 9}x" for i in range(30))
LONG = " ".join(f"p{i}" for i in range(40))
ITEMS = [(1, PASSAGE), (10, LONG), (2, "Short one, here"), (3, None), (4, "!!"), (None, "only hit no name"), (2, LONG[:60])]
DOCS = [
    (1, None), (2, ""), (3, "..."), (4, "start " + LONG + " end"), (4, "start " + LONG + " end"), (None, "a SHORT-one here b"),
    (5, PASSAGE.upper()), (6, " ".join(LONG.split()[5:17])), (7, " ".join(LONG.split()[5:18])), (8, "x only hit no name y"),
    (9, "filler é " * 400 + " ".join(LONG.split()[3:20])), (10, LONG + " " + LONG), (11, "short one"), (12, "here short one"),
    (13, " ".join(LONG.split()[:13][:6] + ["gap"] + LONG.split()[6:13])),
]


@pytest.mark.parametrize("test_bytes", [1 << 20, 40])
def test_against_brute_force(spark, test_bytes):
    docs = spark.createDataFrame([(d, t, "x") for d, t in DOCS], "doc_id long, text string, items string").repartition(3)
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    out = judge_passages(find_passages(docs, items, test_bytes=test_bytes)).collect()
    got = sorted([tuple(r)[:6] for r in out], key=repr)
    assert got == brute(DOCS, ITEMS)
    near = {r["doc_id"]: r["n_near"] for r in out}
    assert near[13] > 0 and near[11] == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert judge_passages(find_passages(docs, items)).collect() == []
    assert [r["n_hit"] for r in judge_passages(find_passages(some, items)).collect()] == [0]
