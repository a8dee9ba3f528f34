"""Quality of documents: a classifier's evidence combined with what is known of their site.

A logistic classifier on the make-up of the text gives each document a probability. Sites are
judged on two levels, host and path below it, by beta-binomial posteriors: a path is shrunk
towards its host and a host towards all documents, the more the fewer documents it has. How much
they differ, and so how strongly they are shrunk, is estimated from the grouped counts themselves
(empirical Bayes).
"""

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, plain_text
from tillmart.llm.frames import named_columns, numbered_columns
from tillmart.workspace import stage

#: Labelled documents the classifier is fitted on, at most; counts and posteriors use all.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
BROADCAST_BYTES = 32 * 1024 * 1024
_CLASSES = [
    range(65, 91), range(97, 123), range(48, 58), range(128, 256), [32], [10], [33], [124], [*b"#*$%&<>"], [*b".,;:?'\"-()"],
]
_MEMBERS = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES):
    _MEMBERS[list(_members), _i] = 1
N_FEATURES = len(_CLASSES) + 5
_MOST_SHRUNK = 1e6


def make_up(text: str) -> list[float]:
    """Shares of character classes, length, word length, distinct words and repeated lines."""
    raw = text.encode()
    if not raw:
        return [0.0] * N_FEATURES
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _MEMBERS / len(raw)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = max(len(words), 1)
    return [
        *shares.tolist(), float(np.log1p(len(raw))), len(raw) / n / 10, len(set(words)) / n,
        1 - len(set(lines)) / max(len(lines), 1), min(len(raw) / max(len(lines), 1) / 1000, 10.0),
    ]


def _featured(batches):
    for batch in bounded(batches, "_text"):
        found = np.array([make_up(t) for t in plain_text(batch.column("_text")).to_pylist()], float).reshape(-1, N_FEATURES)
        names = [n for n in batch.schema.names if n != "_text"]
        features = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * N_FEATURES, pa.int32()), pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), features], [*names, "features"])


def features(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_text`` replaced by its ``features``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return arrow_map(rows, _featured, f"{kinds}, features array<double>")


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic classifier, the intercept last, by Newton's method on scaled features."""
    if not len(y):
        return np.zeros(N_FEATURES + 1)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def _probability(logit: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(p / (1 - p))


def _concentration(groups: DataFrame, n: str, s: str, prior: Column) -> float:
    """How many documents a prior is worth: from how much the groups' shares differ beyond chance."""
    m, v = F.col(s) / F.col(n), prior * (1 - prior)
    r = groups.agg(
        F.sum(F.col(n) * (m - prior) ** 2).alias("spread"), F.sum(v).alias("chance"), F.sum(F.col(n) * v).alias("nv"),
        F.sum(n).alias("n"), F.sum(F.col(n).cast("double") ** 2).alias("n2"),
    ).first()
    if not r["n"] or r["nv"] <= 0:
        return _MOST_SHRUNK
    between = (r["spread"] - r["chance"]) / max(r["n"] - r["n2"] / r["n"], 1e-9)
    return min(_MOST_SHRUNK, max(1.0, (r["nv"] / r["n"]) / between - 1)) if between > 0 else _MOST_SHRUNK


def posteriors(evidence: DataFrame) -> tuple[DataFrame, dict]:
    """(host, path, n_path, s_path, n_host, s_host) and the constants mean, k_host, k_path.

    ``evidence``: host, path, y (1 or 0, or a probability). Grouped with partial sums, so a hot
    host becomes one row per task.
    """
    paths = stage(evidence.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_path"), F.sum("y").alias("s_path")), "path-counts")
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host"))
    sites = stage(paths.join(hosts, "host"), "site-counts")
    total = sites.agg(F.sum("s_path").alias("s"), F.sum("n_path").alias("n")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    own_hosts = sites.groupBy("host").agg(F.max("n_host").alias("n"), F.max("s_host").alias("s"))
    k_host = _concentration(own_hosts, "n", "s", F.lit(mean))
    host_mean = (k_host * mean + F.col("s_host")) / (k_host + F.col("n_host"))
    k_path = _concentration(sites, "n_path", "s_path", host_mean)
    return sites, {"mean": mean, "k_host": k_host, "k_path": k_path}


def judge_rows(rows: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``rows`` (_doc_id, _host, _path, features and others) with doc_score, site_score, score, kept."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_doc_id")).agg(F.min("quality").cast("double").alias("label"))
    slim = rows.select("_doc_id", F.col("_host").alias("host"), F.col("_path").alias("path"), "features")
    labelled = stage(slim.join(known, "_doc_id", "left"), "labelled-features")
    # A hash picks about one and a half samples, so that tasks send no more than that to be ordered.
    candidates = labelled.where("label is not null").withColumn("place", F.xxhash64("_doc_id", "features"))
    share = min(1.0, 1.5 * sample_rows / max(candidates.count(), 1))
    candidates = candidates.where(F.pmod("place", F.lit(1 << 30)) < share * (1 << 30))
    fitted_on = candidates.orderBy("place", "_doc_id").limit(sample_rows).select("features", "label").collect()
    weights = fit(np.array([r["features"] for r in fitted_on], float), np.array([r["label"] for r in fitted_on], float))
    logit = reduce(add, [F.col("features")[i] * float(w) for i, w in enumerate(weights[:-1])], F.lit(float(weights[-1])))
    sites, k = posteriors(labelled.select("host", "path", F.coalesce("label", _probability(logit)).alias("y")))
    n_sites = sites.count()
    width = 64 + 2 * (sites.agg(F.max(F.length("host") + F.length("path"))).first()[0] or 0)
    sites = sites.withColumnsRenamed({"host": "_host", "path": "_path"})
    sites = F.broadcast(sites) if n_sites * width <= BROADCAST_BYTES else sites
    # A document's own evidence is taken out of its site's; unlabelled ones put in their probability.
    p = _probability(logit)
    host = (k["k_host"] * k["mean"] + F.greatest(F.col("s_host") - p, F.lit(0.0))) / (k["k_host"] + F.col("n_host") - 1)
    path = (k["k_path"] * host + F.greatest(F.col("s_path") - p, F.lit(0.0))) / (k["k_path"] + F.col("n_path") - 1)
    score = _probability(logit + _logit(path) - F.lit(float(np.log(k["mean"] / (1 - k["mean"])))))
    return rows.join(sites, ["_host", "_path"]).withColumns({"doc_score": p, "site_score": path, "score": score}).withColumn(
        "kept", F.col("score") >= threshold)


def _prepared(docs: DataFrame, names: dict, host: str, path: str, keep: list[str]) -> DataFrame:
    level = lambda c: F.coalesce(F.col(names[c]).cast("string"), F.lit("")) if c in names else F.lit("")
    return stage(features(docs.select(
        *keep, F.col(names["doc_id"]).alias("_doc_id"), level(host).alias("_host"), level(path).alias("_path"),
        F.col(names["text"]).cast("string").alias("_text"),
    )), "features")


def judge_documents(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
    sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, doc_score, site_score, score and kept of every row of ``docs`` (doc_id, text, host, path).

    ``labels``: doc_id and quality (0 or 1; of several the lowest). The classifier is fitted on at
    most ``sample_rows`` labelled rows, chosen by a hash; every row counts in the posteriors, with
    its label or else its probability. A document is kept from ``threshold`` on. Null text has the
    features of the empty one; a null or missing host or path is an empty one; null doc_ids have no
    label; repeated rows count and are judged each; without labels all is undecided and kept. No
    rows give none; other columns are left out.
    """
    inner, names = numbered_columns(docs)
    judged = judge_rows(_prepared(inner, names, host, path, []), labels, sample_rows, threshold)
    return judged.select(F.col("_doc_id").alias("doc_id"), "doc_score", "site_score", "score", "kept")


def keep_good(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
    sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, with all their columns."""
    inner, names = numbered_columns(docs)
    rows = _prepared(inner, names, host, path, [*names.values()])
    return named_columns(judge_rows(rows, labels, sample_rows, threshold).where("kept"), names)
