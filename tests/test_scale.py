"""What moves between tasks when tables outgrow a broadcast."""

from decimal import Decimal

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tillmart.operators import JoinBounds, customer_month_mart, customer_wide, enrich_sales, rows_without_dimension, sales_wide
from tillmart.operators.enrich import dimension_fit
from tillmart.operators.lookup import PACKED
from tillmart.plans import catalogue
from tillmart.schemas import CUSTOMER_WIDE_COLUMNS, SALES_WIDE_COLUMNS
from tillmart.workspace import together


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(n=40):
    return [(i % 4 + 1 if i % 7 else None, [121, 122, 5][i % 3], "2023-01-05", i % 3 + 1, f"{i}.00") for i in range(n)]


def test_a_table_needed_for_its_key_alone_is_measured_by_its_key(make_fact, customer, store, sales_team):
    customers = customer.unionByName(customer.where("customer_id = 1")).unionByName(
        customer.where("customer_id = 2").withColumn("customer_id", F.lit(None).cast("int")))
    whole = dimension_fit(customers, store, sales_team, JoinBounds(broadcast_bytes=0), SALES_WIDE_COLUMNS)
    assert whole == {"customer": False, "store": False, "sales_team": False}
    # A key takes 24 bytes, a whole customer far more.
    bounds, fact = JoinBounds(5 * 24), make_fact(rows())
    assert not dimension_fit(customers, store, sales_team, bounds)["customer"]
    assert dimension_fit(customers, store, sales_team, bounds, SALES_WIDE_COLUMNS)["customer"]
    thin = sales_wide(enrich_sales(fact, customers, store, sales_team, bounds=bounds, columns=SALES_WIDE_COLUMNS))
    assert tuples(thin) == tuples(sales_wide(enrich_sales(fact, customers, store, sales_team)))
    spent = customer_wide(enrich_sales(fact, customers, store, sales_team, bounds=bounds, columns=CUSTOMER_WIDE_COLUMNS))
    assert tuples(spent) == tuples(customer_wide(enrich_sales(fact, customers, store, sales_team)))


def test_columns_that_no_mart_has_are_not_shuffled(make_fact, customer, store, sales_team):
    fact = make_fact(rows()).withColumn("note", F.lit("x").cast("string"))
    joined = enrich_sales(fact, customer, store, sales_team, fit={"customer": False, "store": True, "sales_team": True})
    assert "note" not in plan_of(joined)


@pytest.fixture
def order_tables(spark, tmp_path):
    def write(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    write("customer", [(i, f"C#{i}", i % 2, 1.0, "SEG") for i in range(5)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    write("supplier", [(i, f"S#{i}", i % 2, 1.0 - i) for i in range(3)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    write("nation", [(0, "N0", 0), (1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int")
    lines = [(i // 2, 1, i % 4, i % 2, 1.0 * i, 10.0 * i, "A", "O") for i in range(60)]
    write("lineitem", lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
          "l_extendedprice double, l_returnflag string, l_linestatus string")
    orders = spark.createDataFrame([(i, i % 6) for i in range(30)], "o_orderkey bigint, o_custkey bigint").withColumn(
        "o_orderdate", F.expr("make_timestamp_ntz(2023, 6 + cast(o_orderkey % 3 as int), 1 + cast(o_orderkey as int) % 28, 0, 0, 0)"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_sales_are_joined_once_when_a_table_is_shuffled(spark, order_tables, monkeypatch):
    expected = tuples(catalogue.month_total(spark, order_tables))
    assert expected
    none_fits = {"customer": False, "store": False, "sales_team": False}
    monkeypatch.setattr(catalogue, "dimension_fit", lambda *tables, **kwargs: none_fits)
    totals = catalogue.month_total(spark, order_tables)
    # What is counted by key and then joined is the written sales.
    assert "lineitem.parquet" not in plan_of(totals)
    assert tuples(totals) == expected


def test_rebuilt_months_are_those_of_all_sales(spark, order_tables, monkeypatch):
    staged = []
    stage = catalogue.stage
    monkeypatch.setattr(catalogue, "stage", lambda df, label, *args: staged.append(df.columns) or stage(df, label, *args))
    assert tuples(catalogue.rebuilt_customer_months(spark, order_tables), *(columns := catalogue.customer_month(spark, order_tables).columns)) == tuples(
        catalogue.customer_month(spark, order_tables), *columns)
    # No table of all columns is written first.
    assert max(len(columns) for columns in staged) == 5


def test_months_over_batches_need_two_shuffles(spark, make_fact, customer, store, sales_team):
    wide = customer_wide(enrich_sales(make_fact(rows()), customer, store, sales_team))
    versions = wide.unionByName(wide.replace("Ash", "Oak", "last_name")).unionByName(
        wide.where("customer_id = 2").withColumn("first_name", F.lit("Rob")))
    mart = customer_month_mart(versions, one_snapshot=False)
    assert plan_of(mart).count("Exchange hashpartitioning") == 2
    total = {1: Decimal(0), 2: Decimal(0), 3: Decimal(0)}
    for r in versions.collect():
        total[r["customer_id"]] += r["total_cost"]
    # Both versions of the second customer have no full name, so they are one row.
    assert tuples(mart, "customer_id", "full_name", "total_sales") == sorted([
        (1, "Ann Ash", total[1]), (1, "Ann Oak", total[1]), (2, None, total[2]), (3, "Cid Cox", total[3]),
    ], key=repr)


def test_works_done_together_give_their_results_and_errors(spark):
    assert together(spark, lambda: 1, lambda: 2) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1, lambda: 1 / 0)


def test_only_joins_with_hot_keys_are_salted(make_fact, customer, store, sales_team):
    # Customers 1 to 20 and none equally often, of whom three are known; two in three sales are one person's.
    many = [((i % 21) or None, [121, 122][i % 2], "2023-01-05", 1 if i % 3 else 2, f"{i}.00") for i in range(210)]
    fact, whole = make_fact(many), {"customer": True, "store": True, "sales_team": True}
    expected = tuples(enrich_sales(fact, customer, store, sales_team, fit=whole))
    assert len(expected) == 30
    cold = enrich_sales(fact, customer, store, sales_team, fit={**whole, "customer": False})
    assert "SortMergeJoin" in plan_of(cold) and "__salt" not in plan_of(cold)
    assert tuples(cold) == expected
    mixed = enrich_sales(fact, customer, store, sales_team, fit={**whole, "customer": False, "sales_team": False})
    plan = plan_of(mixed)
    assert plan.count("SortMergeJoin") == 2 and "__salt" in plan
    assert tuples(mixed) == expected


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_keys_too_large_as_rows_are_looked_up_64_to_a_row(spark, make_fact, customer, store, sales_team, kind):
    # Keys in 6 words of 64, some of them negative, without every seventh, and a NULL.
    ids = spark.range(-130, 130).where("id % 7 <> 0").select(F.col("id").cast(kind).alias("customer_id"))
    customers = customer.drop("customer_id").limit(1).crossJoin(ids.unionByName(ids.limit(1).select(F.lit(None).cast(kind).alias("customer_id"))))
    customers = customers.select(*customer.columns)
    bounds, whole = JoinBounds(6 * 32), {"customer": True, "store": True, "sales_team": True}
    fit = dimension_fit(customers, store, sales_team, bounds, SALES_WIDE_COLUMNS)
    assert fit["customer"] == PACKED
    assert dimension_fit(customers, store, sales_team, JoinBounds(6 * 32 - 1), SALES_WIDE_COLUMNS)["customer"] is False
    assert dimension_fit(customers, store, sales_team, bounds)["customer"] is False
    fact = make_fact([(i if i != 5 else None, 121, "2023-01-05", 1, f"{i}.00") for i in [*range(-200, 200), 1, 1, 2**31 - 1, -2**31]])
    packed, columns = {**whole, "customer": PACKED}, SALES_WIDE_COLUMNS
    joined = enrich_sales(fact, customers, store, sales_team, fit=packed, columns=columns)
    expected = enrich_sales(fact, customers, store, sales_team, fit=whole, columns=columns)
    assert joined.schema == expected.schema and "SortMergeJoin" not in plan_of(joined)
    assert tuples(joined) == tuples(expected) and len(tuples(joined)) > 200
    # Keys that are no whole numbers, and columns beside the key, are joined as before.
    halves = fact.withColumn("customer_id", F.col("customer_id").cast("decimal(12,1)") / 2)
    for sales, wanted in ((halves, columns), (fact.withColumn("customer_id", F.col("customer_id").cast("string")), columns), (fact, CUSTOMER_WIDE_COLUMNS)):
        joined = enrich_sales(sales, customers, store, sales_team, fit=packed, columns=wanted)
        assert tuples(joined) == tuples(enrich_sales(sales, customers, store, sales_team, fit=whole, columns=wanted))
    assert tuples(rows_without_dimension(fact, customers, store, sales_team, fit=packed)) == tuples(
        rows_without_dimension(fact, customers, store, sales_team, fit=whole))


def test_keys_that_repeat_are_not_packed(make_fact, customer, store, sales_team):
    customers = customer.select(*customer.columns).unionByName(customer.where("customer_id = 1"))
    # 4 rows of 24 bytes, one word of 32.
    bounds = JoinBounds(32)
    assert dimension_fit(customer, store, sales_team, bounds, SALES_WIDE_COLUMNS)["customer"] == PACKED
    fit = dimension_fit(customers, store, sales_team, bounds, SALES_WIDE_COLUMNS)
    assert fit["customer"] is False
    joined = enrich_sales(make_fact(rows()), customers, store, sales_team, fit=fit, columns=SALES_WIDE_COLUMNS)
    assert tuples(joined) == tuples(enrich_sales(make_fact(rows()), customers, store, sales_team, columns=SALES_WIDE_COLUMNS))
