import random

from conftest import tuples
from pyspark.sql import functions as F

from tillmart.operators import JoinBounds, enrich_sales, fits_broadcast, hot_keys, lookup_join, rows_without_dimension
from tillmart.operators.enrich import dimension_fit
from tillmart.workspace import shuffle_width


def facts(spark, n=3000, seed=1, hot=0.34):
    rng = random.Random(seed)
    rows = [(7 if rng.random() < hot else rng.choice([None, *range(200)]), i) for i in range(n)]
    return spark.createDataFrame(rows, "k int, v int")


def test_fits_broadcast_measures_rows(spark):
    small = spark.range(10).select("id", F.lit("ab").alias("s"))
    assert fits_broadcast({"a": small, "b": small.limit(0)}, JoinBounds(broadcast_bytes=0)) == {"a": False, "b": True}
    assert fits_broadcast({"a": small}) == {"a": True}
    # 16 for the row, 8 for the number, 8 + 2 for the text.
    assert fits_broadcast({"a": small}, JoinBounds(340)) == {"a": True}
    assert fits_broadcast({"a": small}, JoinBounds(339)) == {"a": False}


def test_hot_keys_are_found_with_their_share(spark):
    fact = facts(spark).withColumn("j", F.lit(5))
    found = {(r["column"], r["key"]): r["copies"] for r in hot_keys(fact, ["k", "j"]).collect()}
    assert found == {("k", "7"): 2, ("j", "5"): 4}
    assert hot_keys(facts(spark, hot=0), ["k"]).collect() == []
    assert hot_keys(facts(spark, n=0), ["k"]).collect() == []


def test_shuffled_salted_and_broadcast_joins_agree(spark):
    fact = facts(spark)
    table = spark.range(0, 150).select(F.col("id").cast("bigint").alias("id"), (F.col("id") * 2).alias("w"))
    expected = tuples(fact.join(table, fact["k"] == table["id"]).select("k", "v", "w"))
    for small in (True, False):
        joined = lookup_join(fact, table, "k", "id", small=small, hot=hot_keys(fact, ["k"]))
        assert joined.columns == ["k", "v", "w"]
        assert tuples(joined) == expected
    cold = facts(spark, hot=0)
    assert tuples(lookup_join(cold, table, "k", "id", small=False)) == tuples(
        lookup_join(cold, table, "k", "id", small=True)
    )


def test_hot_rows_are_spread_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        fact = facts(spark, n=6000)
        table = spark.range(0, 300).select("id", (F.col("id") * 2).alias("w"))
        joined = lookup_join(fact, table, "k", "id", small=False, hot=hot_keys(fact, ["k"]))
        per_task = joined.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count()
        counts = [r["count"] for r in per_task.collect()]
        assert len(counts) >= 3 and max(counts) < sum(counts) * 0.7
        plain = fact.join(table.withColumnRenamed("id", "k"), "k").where("k = 7")
        assert plain.groupBy(F.spark_partition_id()).count().count() == 1
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_enriching_does_not_depend_on_the_join_kind(spark, make_fact, customer, store, sales_team):
    rng = random.Random(9)
    rows = [
        (1 if i % 3 == 0 else rng.choice([1, 2, 3, 4, None]), rng.choice([121, 122, 5]), "2023-01-05", rng.choice([1, 2, 3]), f"{i}.00")
        for i in range(1, 300)
    ]
    fact = make_fact(rows)
    none_fit = JoinBounds(broadcast_bytes=0)
    assert dimension_fit(customer, store, sales_team, none_fit) == {"customer": False, "store": False, "sales_team": False}
    assert tuples(enrich_sales(fact, customer, store, sales_team, bounds=none_fit)) == tuples(
        enrich_sales(fact, customer, store, sales_team)
    )
    assert tuples(rows_without_dimension(fact, customer, store, sales_team, bounds=none_fit)) == tuples(
        rows_without_dimension(fact, customer, store, sales_team)
    )


def test_shuffle_width_grows_with_the_input_only(spark):
    def width():
        return int(spark.conf.get("spark.sql.shuffle.partitions"))

    before = width()
    with shuffle_width(spark, 10):
        assert width() == before
    with shuffle_width(spark, 10**12):
        assert width() == 3726
    with shuffle_width(spark, 10**15):
        assert width() == 3_725_291
    assert width() == before


def test_what_does_not_fit_is_shuffled_and_salted(spark, make_fact, customer, store, sales_team):
    fact = make_fact([(1, 121, "2023-01-05", 1, f"{i}.00") for i in range(60)] + [(None, 122, None, 2, "1.00"), (9, 122, None, 2, "1.00")])
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    joined = enrich_sales(fact, customer, store, sales_team, fit={"customer": False, "store": False, "sales_team": False})
    built = len(jobs.getJobIdsForGroup("building"))
    spark.sparkContext.setJobGroup("running", "")
    assert joined.count() == 60 and built <= 6
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 3 and "__salt" in plan
