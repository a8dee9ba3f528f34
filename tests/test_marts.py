import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

from conftest import tuples
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillmart.operators import (
    JoinBounds,
    customer_month_mart,
    customer_table_rows,
    customer_wide,
    enrich_sales,
    rows_without_dimension,
    sales_team_table_rows,
    sales_wide,
    salesperson_month_mart,
    salesperson_month_total,
    salesperson_rank,
    store_months_fit,
)
from tillmart.operators.marts import salesperson_totals
from tillmart.schemas import CUSTOMER_WIDE_COLUMNS, ENRICHED_COLUMNS, SALES_WIDE_COLUMNS

D = Decimal


def enriched(make_fact, dims, rows):
    return enrich_sales(make_fact(rows), *dims)


def month(day):
    return day and f"{day:%Y-%m}"


def joined(first, last):
    return None if first is None or last is None else f"{first} {last}"


def sums(pairs):
    """Totals per key; NULLs are skipped, a key with nothing else totals NULL."""
    totals = {}
    for key, cost in pairs:
        known = totals.get(key)
        totals[key] = known if cost is None else cost + (known or 0)
    return totals


def brute_customer_mart(wide):
    rows = wide.collect()
    totals = sums(((r["customer_id"], month(r["sales_date"])), r["total_cost"]) for r in rows)
    return {
        (r["customer_id"], joined(r["first_name"], r["last_name"]), r["address"], r["phone_number"],
         month(r["sales_date"]), totals[r["customer_id"], month(r["sales_date"])])
        for r in rows
    }


def brute_sales_mart(wide):
    """(store, person, name, month, total) -> (rank, incentive)."""
    rows = wide.collect()
    totals = sums(((r["store_id"], r["sales_person_id"], r["sales_month"]), r["total_cost"]) for r in rows)
    mart = {
        (r["store_id"], r["sales_person_id"], joined(r["sales_person_first_name"], r["sales_person_last_name"]),
         r["sales_month"], totals[r["store_id"], r["sales_person_id"], r["sales_month"]])
        for r in rows
    }

    def ahead(a, b):
        return a[4] is not None and (b[4] is None or a[4] > b[4])

    result = {}
    for row in mart:
        rank = 1 + sum(ahead(r, row) for r in mart if (r[0], r[3]) == (row[0], row[3]))
        bonus = D("0.00")
        if rank == 1:
            bonus = row[4] and (row[4] / 100).quantize(D("0.01"), ROUND_HALF_UP)
        result[row] = (rank, bonus)
    return result


def random_sales(n, seed):
    rng = random.Random(seed)
    # A third of all rows on one customer, store and sales person; few amounts, so that ties occur.
    return [
        (
            1 if rng.random() < 0.35 else rng.choice([1, 2, 3, 9, None]),
            121 if rng.random() < 0.35 else rng.choice([121, 122, None]),
            rng.choice(["2023-01-05", "2023-01-31", "2023-02-01", "2022-01-05", None]),
            1 if rng.random() < 0.35 else rng.choice([1, 2, 3, 7]),
            rng.choice(["1.00", "2.50", "-1.00", "0.01", "700.00", None]),
        )
        for _ in range(n)
    ]


def test_star_join_columns_and_lost_rows(make_fact, customer, store, sales_team):
    rows = [
        (1, 121, "2023-01-05", 1, "5.00"),
        (None, 121, "2023-01-05", 1, "5.00"), (9, 121, "2023-01-05", 1, "5.00"),
        (1, None, "2023-01-05", 1, "5.00"), (1, 9, "2023-01-05", 1, "5.00"),
        (1, 121, "2023-01-05", None, "5.00"), (1, 121, "2023-01-05", 9, "5.00"), (9, 9, "2023-01-05", 1, "5.00"),
    ]
    result = enriched(make_fact, (customer, store, sales_team), rows)
    assert result.columns == ENRICHED_COLUMNS
    assert [r.asDict() for r in result.collect()] == [{
        "store_id": 121, "sales_date": date(2023, 1, 5), "sales_person_id": 1, "total_cost": D("5.00"),
        "customer_id": 1, "first_name": "Ann", "last_name": "Ash", "address": "Elm St 1", "pincode": "111",
        "phone_number": "555-1", "store_address": "Market Sq", "store_manager_name": "Mia",
        "manager_id": 31, "is_manager": "no", "joining_date": date(2019, 11, 4),
        "sales_person_first_name": "Sam", "sales_person_last_name": "Sun",
        "sales_person_address": "Hill 1", "sales_person_pincode": "701",
    }]
    lost = rows_without_dimension(make_fact(rows), customer, store, sales_team)
    assert tuples(lost) == [("customer", 3), ("sales_team", 2), ("store", 3)]


def test_wide_marts(make_fact, customer, store, sales_team):
    e = enriched(make_fact, (customer, store, sales_team), [(2, 122, "2023-01-05", 2, "5.00")])
    assert customer_wide(e).columns == CUSTOMER_WIDE_COLUMNS
    assert sales_wide(e).columns == [*SALES_WIDE_COLUMNS, "sales_month"]
    assert tuples(customer_wide(e)) == [(2, "Bob", None, "Elm St 2", "222", "555-2", date(2023, 1, 5), D("5.00"))]
    assert tuples(sales_wide(e)) == [
        (122, 2, "Tia", "Tor", "Max", 31, "no", "Hill 2", "702", date(2023, 1, 5), D("5.00"), "2023-01")
    ]


def test_customer_months(make_fact, customer, store, sales_team):
    e = enriched(make_fact, (customer, store, sales_team), [
        (1, 121, "2023-01-05", 1, "5.00"), (1, 122, "2023-01-31", 2, "1.25"), (1, 121, "2023-02-01", 1, None),
        (2, 121, "2023-01-05", 1, "2.00"),
    ])
    assert tuples(customer_month_mart(customer_wide(e))) == [
        (1, "Ann Ash", "Elm St 1", "555-1", "2023-01", D("6.25")),
        (1, "Ann Ash", "Elm St 1", "555-1", "2023-02", None),
        (2, None, "Elm St 2", "555-2", "2023-01", D("2.00")),
    ]


def test_incentive_goes_to_every_top_seller_of_a_store_and_month(make_fact, customer, store, sales_team):
    e = enriched(make_fact, (customer, store, sales_team), [
        (1, 121, "2023-01-05", 1, "28.50"), (1, 121, "2023-01-06", 2, "20.00"), (2, 121, "2023-01-07", 2, "8.50"),
        (1, 121, "2023-01-07", 3, "28.49"),
        (1, 121, "2023-02-07", 3, "10.00"), (1, 121, "2023-02-07", 1, None),
        (1, 122, "2023-01-07", 1, None), (1, 122, "2023-01-07", 2, None),
        (1, 122, None, 2, "3.00"),
    ])
    assert tuples(salesperson_month_mart(sales_wide(e))) == sorted([
        (121, 1, "Sam Sun", "2023-01", D("28.50"), D("0.29")),
        (121, 2, "Tia Tor", "2023-01", D("28.50"), D("0.29")),
        (121, 3, None, "2023-01", D("28.49"), D("0.00")),
        (121, 3, None, "2023-02", D("10.00"), D("0.10")),
        (121, 1, "Sam Sun", "2023-02", None, D("0.00")),
        (122, 1, "Sam Sun", "2023-01", None, None),
        (122, 2, "Tia Tor", "2023-01", None, None),
        (122, 2, "Tia Tor", None, D("3.00"), D("0.03")),
    ], key=repr)


def test_rate_is_a_parameter(make_fact, customer, store, sales_team):
    e = enriched(make_fact, (customer, store, sales_team), [(1, 121, "2023-01-05", 1, "10.00")])
    assert tuples(salesperson_month_mart(sales_wide(e), D("0.025")), "incentive") == [(D("0.25"),)]


def ordered(rows):
    return sorted(rows, key=repr)


def test_marts_against_brute_force(make_fact, customer, store, sales_team):
    e = enriched(make_fact, (customer, store, sales_team), random_sales(600, 1))
    wide = sales_wide(e)
    expected = brute_sales_mart(wide)
    assert tuples(salesperson_month_mart(wide)) == ordered((*row, bonus) for row, (_, bonus) in expected.items())
    assert tuples(salesperson_month_total(wide)) == ordered(expected)
    assert tuples(salesperson_rank(salesperson_month_total(wide))) == ordered(
        (*row, rank) for row, (rank, _) in expected.items()
    )
    assert tuples(customer_month_mart(customer_wide(e))) == ordered(brute_customer_mart(customer_wide(e)))


def test_totals_keep_the_money(make_fact, customer, store, sales_team):
    e = enriched(make_fact, (customer, store, sales_team), random_sales(300, 2))
    whole = e.agg(F.sum("total_cost")).first()[0]
    assert customer_month_mart(customer_wide(e)).agg(F.sum("total_sales")).first()[0] == whole
    assert salesperson_month_mart(sales_wide(e)).agg(F.sum("total_sales")).first()[0] == whole


def test_several_snapshots_keep_the_full_total_per_version(spark, make_fact, customer, store, sales_team):
    rows = random_sales(300, 3)
    moved = customer.withColumn("address", F.concat(F.lit("New "), "address"))
    renamed = sales_team.withColumn("last_name", F.when(F.col("id") == 1, "Moon").otherwise(F.col("last_name")))
    e = enriched(make_fact, (customer, store, sales_team), rows).unionByName(
        enriched(make_fact, (moved, store, renamed), random_sales(200, 4))
    )
    assert tuples(customer_month_mart(customer_wide(e), one_snapshot=False)) == ordered(
        brute_customer_mart(customer_wide(e))
    )
    assert tuples(salesperson_month_mart(sales_wide(e), one_snapshot=False)) == ordered(
        (*row, bonus) for row, (_, bonus) in brute_sales_mart(sales_wide(e)).items()
    )


def test_rank_over_wide_ranges_and_ties(spark):
    rng = random.Random(5)
    rows = []
    for i in range(800):
        store = 1 if i % 3 == 0 else rng.choice([1, 2, None])
        amount = rng.choice([None, "0.00", "655.35", "655.36", "-0.01", "-655.36", str(rng.randrange(-10**9, 10**9) / 100)])
        rows.append((store, i, rng.choice(["2023-01", None]), amount and D(amount)))
    totals = spark.createDataFrame(rows, "store_id int, sales_person_id int, sales_month string, total_sales decimal(28,2)")
    window = Window.partitionBy("store_id", "sales_month").orderBy(F.col("total_sales").desc())
    assert tuples(salesperson_rank(totals), "sales_person_id", "rnk") == tuples(
        totals.withColumn("rnk", F.rank().over(window)), "sales_person_id", "rnk"
    )


def test_table_rows(make_fact, customer, store, sales_team):
    e = enriched(make_fact, (customer, store, sales_team), [(1, 121, "2023-02-05", 1, "10.00")])
    c = customer_table_rows(customer_month_mart(customer_wide(e)))
    s = sales_team_table_rows(salesperson_month_mart(sales_wide(e)))
    assert dict(c.dtypes)["sales_date_month"] == "date" and dict(c.dtypes)["total_sales"] == "decimal(10,2)"
    assert dict(s.dtypes)["total_sales"] == dict(s.dtypes)["incentive"] == "decimal(10,2)"
    assert tuples(c, "sales_date_month") == [(date(2023, 2, 1),)]


def test_rows_are_combined_before_the_shuffle_and_maxima_reuse_it(make_fact, customer, store, sales_team):
    mart = salesperson_month_mart(sales_wide(enriched(make_fact, (customer, store, sales_team), random_sales(200, 6))))
    mart.collect()
    plan = mart._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "partial_sum" in plan and "partial_max" in plan
    assert "ReusedExchange" in plan
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_maxima_known_to_be_small_are_broadcast_at_once(make_fact, customer, store, sales_team):
    wide = sales_wide(enriched(make_fact, (customer, store, sales_team), random_sales(200, 7)))
    totals = salesperson_totals(wide)
    assert store_months_fit(totals) and not store_months_fit(totals, JoinBounds(broadcast_bytes=0))
    mart = salesperson_month_mart(wide, small_maxima=True)
    assert tuples(mart) == tuples(salesperson_month_mart(wide))
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("Initial Plan")[-1]
