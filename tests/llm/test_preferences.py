import pytest

from tillmart.llm.preferences import END, cut_short, format_preferences


def brute(turns, pairs, per=1024):
    key = lambda t: tuple((x is not None, x or type(x)() if x is not None else 0) for x in t)
    conv = {}
    for c, t, r, x in turns:
        if c is not None:
            conv.setdefault(c, []).append((t, r, x))
    conv = {c: [(r, x) for _, r, x in sorted(v, key=lambda t: tuple((x is not None, x) if x is not None else (False,) for x in t))] for c, v in conv.items()}
    out = []
    for pair, a, b in pairs:
        a, b = conv.get(a, []), conv.get(b, [])
        if pair is None or not a and not b:
            continue
        n = next((i for i in range(max(len(a), len(b))) if a[i:i + 1] != b[i:i + 1]), max(len(a), len(b)))
        for p in range(-(-max(len(a), len(b)) // per)):
            row = [pair, p, n]
            for side, keep in ((a, True), (a, False), (b, False)):
                text, mask = "", []
                for i, (role, x) in enumerate(side):
                    if i // per == p and (i < n) == keep:
                        text += f"<|{role or ''}|>\n"
                        body = (x or "") + END
                        if role == "assistant":
                            mask += [len(text), len(text) + len(body)]
                        text += body
                row += [text] if keep else [text, mask]
            out.append(tuple(row))
    return sorted(out)


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi é😀"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"), (1, 4, "assistant", "ciao"),
    (2, 0, "system", "be kind"), (2, 1, "user", "hi é😀"), (2, 2, "assistant", "go away"),
    (3, 5, "user", None), (3, 7, "assistant", ""), (4, 1, "user", None), (4, 2, "assistant", ""), (4, 3, None, "x"),
    (5, 0, "user", "other"), (6, 0, "user", "q"), (6, 0, "user", "q"), (6, None, "assistant", "first"), (7, 0, "user", "q"),
    (None, 0, "user", "lost"), (8, 0, "user", "long " * 20000), (8, 1, "assistant", "y"), (9, 0, "user", "long " * 20000), (9, 1, "assistant", "z"),
]
PAIRS = [(10, 1, 2), (11, 3, 4), (12, 1, 5), (13, 6, 7), (14, 1, 1), (15, 1, 99), (16, 98, 99), (None, 1, 2), (17, 8, 9), (18, 2, 1), (19, 99, 5), (20, None, 5)]


@pytest.mark.parametrize("per", [1024, 2])
def test_against_brute_force(spark, per):
    turns = spark.createDataFrame([(*t, 7) for t in TURNS], "conv_id long, turn long, role string, text string, pos long").repartition(3)
    pairs = spark.createDataFrame([(*p, 1) for p in PAIRS], "pair_id long, chosen_id long, rejected_id long, piece int")
    got = sorted(tuple(r) for r in format_preferences(turns, pairs, turns_per_piece=per).collect())
    assert got == brute(TURNS, PAIRS, per)


def test_cut_short(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "abcdef"), (1, 2, "user", "z"), (2, 0, "user", "only")], "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r) for r in cut_short(turns).collect()) == [(-3, 0, "user", "only"), (-2, 0, "user", "q"), (-2, 1, "assistant", "abc")]


def test_empty(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    pairs = spark.createDataFrame([], "pair_id long, chosen_id long, rejected_id long")
    assert format_preferences(turns, pairs).collect() == []
