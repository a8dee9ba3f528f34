"""Quality rules whose cutoffs are chosen under risk control. DataFrame functions only.

A rule rejects documents whose measure lies above a cutoff. On a labelled holdout an exact
binomial test says whether a cutoff falsely rejects at most a given share of the good documents
of a stratum; the strictest cutoff that passes is used, corrected for all tests made.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillmart.workspace import stage

SHORTEST = 50
#: False rejections of good documents, at most, per stratum and over all rules; chance that this is broken anywhere.
RISK, CONFIDENCE_LOST = 0.02, 0.05
#: name: (numerator, denominator, cutoffs in thousandths from lax to strict)
RULES = {
    "symbols": ("n_symbols", "word_chars", (500, 300, 200, 150, 100, 80, 60, 50, 40, 30, 20, 10)),
    "dup_lines": ("n_dup_lines", "n_lines", (900, 700, 500, 400, 300, 200, 150, 100, 50)),
    "repeats": ("n_repeat_words", "n_words", (450, 400, 350, 300, 250, 200, 150, 100, 50)),
    "long_words": ("word_chars", "n_words", (30000, 20000, 15000, 12000, 10000, 9000, 8000, 7000)),
}
_BLANKS = " \t\n\x0b\x0c\r"


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of ``text``.

    Repeated windows are found by sorting a text's own windows, so nothing is shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    solid = F.translate(text, _BLANKS, "")
    rows = docs.select(
        *keep, F.array_remove(F.split(F.translate(text, _BLANKS[1:], " " * 5), " "), "").alias("_words"),
        F.length(solid).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, _BLANKS, "")) > 0).alias("_lines"),
    )
    n = F.size("_words")
    shifted = [F.slice("_words", i, F.greatest(n - 2, F.lit(0))) for i in (1, 2, 3)]
    windows = F.zip_with(F.zip_with(shifted[0], shifted[1], lambda a, b: F.concat(a, F.lit(" "), b)), shifted[2], lambda a, b: F.concat(a, F.lit(" "), b))
    rows = rows.select(
        *keep, "word_chars", "n_symbols", n.cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))).alias("_sorted"),
    )
    m = F.greatest(F.size("_sorted") - 1, F.lit(0))
    twice = F.zip_with(F.slice("_sorted", 1, m), F.slice("_sorted", 2, m), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    rows = rows.withColumn("_starts", F.sort_array(F.array_distinct(F.flatten(F.array_compact(twice))))).drop("_sorted")
    # A window covers three words, or as many as lie before the next one.
    k = F.size("_starts")
    steps = F.zip_with(F.slice("_starts", 1, F.greatest(k - 1, F.lit(0))), F.slice("_starts", 2, F.greatest(k - 1, F.lit(0))), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.aggregate(steps, F.when(k > 0, 3).otherwise(0), lambda s, x: s + x).cast("long")
    return rows.withColumn("n_repeat_words", covered).drop("_starts")


def _log_gamma(x: Column) -> Column:
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5))
    for i in range(8):
        series = series - F.log(x + i)
    return series


def binomial_at_most(k: Column, n: Column, p: float, terms: int = 10_000) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), never less than it is; 1 where k lies at or above the mean.

    Summed downwards from k, where terms shrink; what follows ``terms`` terms is bounded by a
    geometric series.
    """
    k, n = k.cast("double"), n.cast("double")
    log_p = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    ratio = lambda i: (k - i) / (n - k + 1 + i) * ((1 - p) / p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    steps = F.sequence(F.lit(0), F.least(k, F.lit(float(terms))).cast("int"))
    added = F.aggregate(steps, start, lambda s, i: F.struct((s["term"] * ratio(i)).alias("term"), (s["sum"] + s["term"] * ratio(i)).alias("sum")))
    last = ratio(F.least(k, F.lit(float(terms))))
    total = added["sum"] + added["term"] * last / (1 - last)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_p) * total))


def _above(rule: str, cutoff) -> Column:
    numerator, denominator, _ = RULES[rule]
    return 1000 * F.col(numerator) > cutoff * F.col(denominator)


def certify(holdout: DataFrame, risk: float = RISK, lost: float = CONFIDENCE_LOST) -> DataFrame:
    """One row per stratum: a cutoff of each rule, null where none is certified.

    ``holdout``: stratum and the measures of good documents. Cutoffs are fixed beforehand and
    tested from lax to strict, stopping at the first that fails, which needs no correction; over
    strata and rules the chance of error is divided (Bonferroni), and each rule gets an equal part
    of the risk.
    """
    steps = [(rule, i, cutoff) for rule, (_, _, cutoffs) in RULES.items() for i, cutoff in enumerate(cutoffs)]
    counts = holdout.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(_above(rule, cutoff)).alias(f"{rule}_{i}") for rule, i, cutoff in steps])
    strata = counts.agg(F.count(F.lit(1)).alias("strata"))
    tests = counts.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(cutoff).alias("cutoff"), F.col(f"{rule}_{i}").alias("k"))
        for rule, i, cutoff in steps
    ])).alias("t")).select("stratum", "n", "t.*")
    # One row.
    tests = tests.join(F.broadcast(strata))
    passed = binomial_at_most(F.col("k"), F.col("n"), risk / len(RULES)) <= lost / (F.col("strata") * len(RULES))
    order = W.partitionBy("stratum", "rule").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    so_far = tests.withColumn("passed", F.min(passed.cast("int")).over(order))
    return so_far.groupBy("stratum").agg(*[
        F.min(F.when((F.col("rule") == rule) & (F.col("passed") == 1), F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES
    ])


def judge_quality(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, lost: float = CONFIDENCE_LOST
) -> DataFrame:
    """Measures, base_failed, kept and failed_rules of every row of ``docs`` (doc_id, text, ``stratum``).

    ``labels``: doc_id, quality; good documents are those all of whose labels are 1. A null text
    has no words and fails; a null stratum is one of its own; a stratum without enough labels has
    no cutoffs and rejects nothing beyond the base rules. Repeated rows are judged alike and each
    counts in the holdout; null doc_ids have no label; other columns are left out; no rows give none.
    """
    rows = docs.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "text")
    measured = stage(measure(rows, ["doc_id", "stratum"]), "measures")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    cutoffs = stage(certify(measured.join(good, "doc_id", "left_semi"), risk, lost), "cutoffs")
    # As many rows as strata; Spark sends them to all tasks if its own bound allows.
    judged = measured.join(cutoffs, "stratum", "left")
    failed = F.array_compact(F.array(*[F.when(_above(rule, F.col(f"cut_{rule}")), F.lit(rule)) for rule in RULES]))
    base = (F.col("n_words") < SHORTEST) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & (F.size(failed) == 0)).alias("kept"), F.array_join(failed, ",").alias("failed_rules"),
    )
