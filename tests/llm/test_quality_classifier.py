import random

import numpy as np
import pytest

from tillmart.llm.quality_classifier import N_FEATURES, fit, judge_documents, keep_good, make_up, posteriors


def docs_and_labels(n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        source = "big" if i % 3 == 0 else f"s{rng.randrange(8)}"
        bad = rng.random() < (0.6 if source == "s1" else 0.1)
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(5, 60))]
        text = "!! ".join(w.upper() for w in words) if bad else " ".join(words) + "."
        rows.append((i, text, "en" if i % 2 else "de", source, 1.0))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_make_up():
    assert make_up("") == [0.0] * N_FEATURES
    f = make_up("AB cd!\nAB cd!\n")
    assert len(f) == N_FEATURES and f[0] == pytest.approx(4 / 14) and f[6] == pytest.approx(2 / 14)
    assert f[12] == pytest.approx(0.5) and f[13] == pytest.approx(0.5)


def test_fit_has_no_gradient_left():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, N_FEATURES))
    y = (x[:, 0] + rng.normal(size=500) > 0).astype(float)
    w = fit(x, y)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert abs((p - y).sum()) < 0.1 and ((p > 0.5) == y).mean() > 0.7


def test_posteriors_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"h{h}", f"p{p}", float(rng.random() < 0.2 + 0.06 * h)) for h in range(10) for p in range(3) for _ in range(rng.randint(1, 40))]
    sites, k = posteriors(spark.createDataFrame(rows, "host string, path string, y double"))
    y = np.array([r[2] for r in rows])
    mean = y.mean()
    assert k["mean"] == pytest.approx(mean)

    def moments(groups, priors):
        n = np.array([len(g) for g in groups])
        v = priors * (1 - priors)
        between = ((n * (np.array([np.mean(g) for g in groups]) - priors) ** 2).sum() - v.sum()) / (n.sum() - (n ** 2).sum() / n.sum())
        return min(1e6, max(1.0, (n * v).sum() / n.sum() / between - 1)) if between > 0 else 1e6

    by = {}
    for h, p, v in rows:
        by.setdefault(h, {}).setdefault(p, []).append(v)
    hosts = {h: [v for vs in ps.values() for v in vs] for h, ps in by.items()}
    k_host = moments([*hosts.values()], np.full(len(hosts), mean))
    assert k["k_host"] == pytest.approx(k_host)
    host_mean = {h: (k_host * mean + sum(v)) / (k_host + len(v)) for h, v in hosts.items()}
    groups = [(h, vs) for h, ps in by.items() for vs in ps.values()]
    assert k["k_path"] == pytest.approx(moments([vs for _, vs in groups], np.array([host_mean[h] for h, _ in groups])))
    assert {(r["host"], r["path"]): (r["n_path"], r["n_host"]) for r in sites.collect()} == {
        (h, p): (len(vs), len(hosts[h])) for h, ps in by.items() for p, vs in ps.items()}


def test_held_out_accuracy_and_rows_kept(spark):
    rows, labels = docs_and_labels()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double").repartition(3)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in judge_documents(docs, table).collect()}
    assert len(out) == len(rows)
    held_out = [r for r in rows if r[0] % 2]
    assert sum(out[r[0]]["kept"] == ("!!" not in r[1]) for r in held_out) >= 0.97 * len(held_out)
    kept = keep_good(docs, table)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in out.items() if r["kept"])
    sites = {r[3]: out[r[0]]["site_score"] for r in rows}
    assert sites["s1"] < min(v for s, v in sites.items() if s != "s1")


def test_odd_rows(spark):
    rows, labels = docs_and_labels(60)
    odd = [(None, None, None, None, 0.0), (1000, "", None, "big", 0.0), (1001, "a " * 300000, "xx", "", 0.0), rows[4], rows[4]]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string, score double")
    table = spark.createDataFrame(labels + [(4, 1, 0), (None, 0, 0), (7777, 0, 0)], "doc_id long, quality int, toxic int")
    assert judge_documents(docs, table).count() == len(rows) + len(odd)
    none = table.limit(0)
    assert all(r["kept"] for r in judge_documents(docs, none).collect())
    assert judge_documents(docs.limit(0), table).collect() == []
    assert judge_documents(docs.drop("source", "lang"), table).count() == len(rows) + len(odd)
