"""Judging urls by rules, and hosts without a rule by trust and distrust spread over the host graph.

Trust is a personalised PageRank from hosts with allowed urls along the links; distrust is one
from hosts with blocked urls against them: who links to a blocked host is suspect. DataFrame
functions only.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.workspace import stage

#: (verdict, host, path): a rule fits its host and all hosts below it, if the path begins with its own
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
DAMPING = 0.85
ROUNDS = 10
#: A host is blocked if its distrust is more than this many times its trust.
THRESHOLD = 1.5
_LEAST = 1e-12
#: Links in the page whose address names a host; the second group of the url pattern is its path.
LINK = r"(?i)href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, of, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(begin)
        rule, verdict = F.when(fits, of + begin).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from the pages of one host to another, and each host with the one above it.

    Links are counted before they are shuffled. A host belongs to the one above it, and that one
    vouches for it, as far as that has at least two labels.
    """
    named = pages.where(F.col("host") != "")
    linked = named.select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("to"))
    links = linked.select(F.col("host").alias("src"), F.translate("to", _UPPER, _LOWER).alias("dst")).where("src <> dst")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    hosts = named.select("host").distinct()
    labels = F.split("host", r"\.")
    deeper = F.filter(F.sequence(F.lit(0), F.size("labels") - 3), lambda i: i >= 0)
    above = hosts.withColumn("labels", labels).where(F.size("labels") >= 3).select("labels", F.explode(deeper).alias("i"))
    above = above.select(
        F.array_join(F.slice("labels", F.col("i") + 1, F.size("labels")), ".").alias("src"),
        F.array_join(F.slice("labels", F.col("i") + 2, F.size("labels")), ".").alias("dst"),
    ).distinct().withColumn("n", F.lit(1).cast("long"))
    below = above.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    return links.unionByName(above).unionByName(below).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, rank) after ``rounds`` steps of personalised PageRank, for each kind on its own.

    ``edges``: kind, src, dst, weight (summing to 1 per kind and src). ``seeds``: kind, host, seed
    (summing to 1 per kind). What reaches a host without links out returns to the seeds. Every
    fifth step is a written table.
    """
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    sources = stage(edges.select("kind", F.col("src").alias("host")).distinct(), "link-sources")
    for i in range(rounds):
        moved = ranks.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
        moved = moved.select("kind", F.col("dst").alias("host"), (damping * F.col("rank") * F.col("weight")).alias("rank"))
        ended = ranks.join(sources, ["kind", "host"], "left_anti").groupBy("kind").agg(F.sum("rank").alias("ended"))
        # One row per kind.
        again = seeds.join(F.broadcast(ended), "kind", "left").select(
            "kind", "host", ((1 - damping + damping * F.coalesce("ended", F.lit(0.0))) * F.col("seed")).alias("rank"))
        ranks = moved.unionByName(again).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % 5 == 4:
            ranks = stage(ranks, "ranks")
    return ranks


def host_ranks(pages: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) of ``pages`` (host, html, verdict of its rule or null)."""
    judged = pages.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").alias("trust"), F.count_if(F.col("verdict") == "block").alias("distrust"))
    seeds = judged.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("trust").alias("n")), F.struct(F.lit("distrust").alias("kind"), F.col("distrust").alias("n"))
    )).alias("s")).select("s.kind", "host", "s.n").where("n > 0")
    seeds = stage(seeds, "seeds")
    totals = seeds.groupBy("kind").agg(F.sum("n").alias("total"))
    # Two rows of totals.
    seeds = stage(seeds.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("seed")), "seed-shares")
    links = stage(host_edges(pages), "host-links")
    along = links.select(F.lit("trust").alias("kind"), "src", "dst", "n")
    against = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    both = along.unionByName(against)
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    edges = stage(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("out")).alias("weight")), "host-edges")
    ranks = propagate(edges, seeds, damping, rounds)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    return ranks.groupBy("host").agg(of("trust"), of("distrust"))


def judge_urls(
    pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS, threshold: float = THRESHOLD
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every row of ``pages`` (page_id, url, html).

    Null urls and those without ``://`` have an empty host and path, no rule and are allowed, as
    are hosts that neither trust nor distrust reaches. Null html has no links. Repeated rows are
    judged alike and each counts as a seed; other columns are left out; no rows give none.
    """
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string").alias("html"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    ranks = stage(host_ranks(rows.select("host", "html", "verdict"), damping, rounds), "host-ranks")
    # Joined by shuffle unless Spark finds the ranks small; hosts are unique in them.
    known = rows.select("page_id", "host", "path", "rule", "verdict").join(ranks, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    blocked = distrust > threshold * trust + _LEAST
    return known.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
