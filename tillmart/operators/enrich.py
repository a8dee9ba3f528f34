"""The sales fact together with its customer, store and sales-staff data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions import month_of
from tillmart.operators.lookup import DEFAULT_BOUNDS, PACKED, JoinBounds, fits_broadcast, fits_packed, hot_keys, lookup_join, whole_numbers
from tillmart.schemas import CUSTOMER_WIDE_COLUMNS, ENRICHED_COLUMNS, SALES_WIDE_COLUMNS


def customer_side(customer: DataFrame) -> DataFrame:
    return customer.drop("customer_joining_date")


def store_side(store: DataFrame) -> DataFrame:
    """The store's address gets its own name; plain ``address`` stays the customer's."""
    return store.select("id", F.col("address").alias("store_address"), "store_manager_name")


def sales_team_side(sales_team: DataFrame) -> DataFrame:
    st = sales_team.alias("st")
    return st.select(
        "id", "manager_id", "is_manager", "joining_date",
        F.col("st.first_name").alias("sales_person_first_name"),
        F.col("st.last_name").alias("sales_person_last_name"),
        F.col("st.address").alias("sales_person_address"),
        F.col("st.pincode").alias("sales_person_pincode"),
    )


def _lookups(customer: DataFrame, store: DataFrame, sales_team: DataFrame, columns: list[str]) -> list[tuple]:
    """(name, table, key in the fact, key in the table) of each lookup; a table has its key and those of ``columns`` it gives."""
    sides = (
        ("customer", customer_side(customer), "customer_id", "customer_id"),
        ("store", store_side(store), "store_id", "id"),
        ("sales_team", sales_team_side(sales_team), "sales_person_id", "id"),
    )
    return [
        (name, side.select(table_key, *[c for c in side.columns if c != table_key and c in columns]), key, table_key)
        for name, side, key, table_key in sides
    ]


def dimension_fit(
    customer, store, sales_team, bounds: JoinBounds = DEFAULT_BOUNDS, columns: list[str] = ENRICHED_COLUMNS
) -> dict[str, bool | str]:
    """Which dimensions are small enough to broadcast, measured on the columns in use: their keys and those of ``columns``.

    One that is needed for its key alone and too large as rows may still be small with 64 keys to a row: ``PACKED``.
    """
    sides = {name: side for name, side, _, _ in _lookups(customer, store, sales_team, columns)}
    fit = fits_broadcast(sides, bounds)
    return {name: fits or (fits_packed(sides[name], bounds) and PACKED) for name, fits in fit.items()}


def enrich_sales(
    fact: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    *,
    fit: dict[str, bool | str] | None = None,
    bounds: JoinBounds = DEFAULT_BOUNDS,
    columns: list[str] = ENRICHED_COLUMNS,
) -> DataFrame:
    """Three inner lookups. A sale with an unknown or NULL key is left out.

    ``columns`` are those wanted of the enriched ones; the rows are the same whichever they are. A
    table that is needed for its key alone is small for longer.

    Pass ``fit`` (see ``dimension_fit``) to reuse a measurement. The customer, the one table
    that can outgrow a broadcast, comes first: its shuffle then carries five columns only.
    Hot keys of all tables that do not fit are counted in one job, on ``fact`` itself; pass a
    fact that is written. A join without hot keys is not salted. No other column of ``fact`` than
    the five is shuffled.
    """
    fit = fit or dimension_fit(customer, store, sales_team, bounds, columns)
    joined = fact.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")
    lookups = _lookups(customer, store, sales_team, columns)
    # Packed keys are looked up by whole numbers only, and give no column.
    small = {
        name: fit[name] if fit[name] != PACKED else whole_numbers(joined, key) and len(side.columns) == 1 and PACKED
        for name, side, key, _ in lookups
    }
    shuffled = [key for name, _, key, _ in lookups if not small[name]]
    hot = hot_keys(joined, shuffled) if shuffled else None
    # Fewer rows than shuffle partitions a column, see hot_keys.
    salted = {r["column"] for r in hot.select("column").collect()} if shuffled else set()
    for name, side, key, table_key in lookups:
        joined = lookup_join(joined, side, key, table_key, small=small[name], hot=hot if key in salted else None)
    return joined.select(*[c for c in ENRICHED_COLUMNS if c in columns])


def customer_wide(enriched: DataFrame) -> DataFrame:
    return enriched.select(*CUSTOMER_WIDE_COLUMNS)


def sales_wide(enriched: DataFrame) -> DataFrame:
    return enriched.select(*SALES_WIDE_COLUMNS, month_of("sales_date").alias("sales_month"))


def rows_without_dimension(
    fact: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    *,
    fit: dict[str, bool | str] | None = None,
    bounds: JoinBounds = DEFAULT_BOUNDS,
) -> DataFrame:
    """Sales the inner lookups leave out, one row per dimension: dimension, rows_lost.

    Nothing is shuffled for a dimension that fits a broadcast. For a larger one rows are
    counted per key before the anti-join, so neither NULLs nor one bad id make a hot task.
    """
    fit = fit or dimension_fit(customer, store, sales_team, bounds)
    report = None
    for name, key, table, table_key in (
        ("customer", "customer_id", customer, "customer_id"),
        ("store", "store_id", store, "id"),
        ("sales_team", "sales_person_id", sales_team, "id"),
    ):
        sold = fact.select(F.col(key).alias("key"))
        known = table.select(F.col(table_key).alias("key"))
        if fit[name] is True:
            unknown = sold.join(F.broadcast(known), "key", "left_anti").select(F.lit(1).alias("n"))
        else:
            per_key = sold.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            unknown = per_key.join(known, "key", "left_anti")
        lost = unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_lost"))
        lost = lost.select(F.lit(name).alias("dimension"), "rows_lost")
        report = lost if report is None else report.unionAll(lost)
    return report


def fact_report(
    fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
    *, fit: dict[str, bool | str], counts: list[str],
) -> dict:
    """Rows, sums of ``counts`` and lost rows by dimension, in one pass for all that fit a broadcast."""
    keys = (("customer", "customer_id", customer, "customer_id"), ("store", "store_id", store, "id"), ("sales_team", "sales_person_id", sales_team, "id"))
    rows, totals = fact, [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]]
    for name, key, table, table_key in keys:
        if fit[name] is True:
            known = table.select(F.col(table_key).alias(key)).distinct().withColumn(f"__{name}", F.lit(True))
            rows = rows.join(F.broadcast(known), key, "left")
            totals.append(F.count_if(F.col(f"__{name}").isNull()).alias(f"lost_{name}"))
    seen = rows.agg(*totals).first().asDict()
    lost = {name: seen.pop(f"lost_{name}") for name, *_ in keys if fit[name] is True}
    for name, key, table, table_key in keys:
        if fit[name] is not True:
            per_key = fact.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            unknown = per_key.join(table.select(F.col(table_key).alias("key")), "key", "left_anti")
            lost[name] = unknown.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return {**seen, "rows_lost": {name: lost[name] for name, *_ in keys}}
