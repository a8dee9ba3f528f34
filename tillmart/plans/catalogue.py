"""Every operator as a query over the given tables, and its SQL counterpart.

Money is computed in decimals and turned into doubles, dates into text, at the very end, so
that both engines hash the same values.
"""

import uuid
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions import base_name
from tillmart.operators import (
    customer_month_mart,
    customer_table_rows,
    customer_wide,
    enrich_sales,
    in_flight_names,
    ledger_close,
    ledger_open,
    ledger_reject,
    ledger_state,
    pending_files,
    rows_without_dimension,
    sales_wide,
    salesperson_month_total,
    salesperson_rank,
)
from tillmart.operators.enrich import dimension_fit
from tillmart.operators.marts import salesperson_incentives, salesperson_totals, store_months_fit
from tillmart.plans import deliveries, retail_tables
from tillmart.plans.daily import DailyConfig, open_batch, run
from tillmart.plans.months import rebuild_months, touched_months
from tillmart.schemas import CUSTOMER_WIDE_COLUMNS, ENRICHED_COLUMNS, SALES_WIDE_COLUMNS
from tillmart.sinks import JdbcSink, snapshot_path, write_parquet
from tillmart.sources import JdbcSource, file_inventory, read_drops, validate_headers
from tillmart.sources.drops import COUNTS
from tillmart.workspace import new_folder, stage, together

NOW = datetime(2024, 1, 15, 12, 0, 0, tzinfo=timezone.utc)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        column = F.col(field.name)
        if kind == "decimal":
            column = column.cast("double").alias(field.name)
        elif kind in ("date", "timestamp"):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _dimensions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [make(spark, sf_dir) for make in (retail_tables.customer, retail_tables.store, retail_tables.sales_team)]


def _enriched(spark: SparkSession, sf_dir: str, columns: list[str] = ENRICHED_COLUMNS, fact: DataFrame | None = None) -> DataFrame:
    """Sales with those ``columns``. Sales that will be counted by key as well as joined are written first."""
    dimensions = _dimensions(spark, sf_dir)
    fit = dimension_fit(*dimensions, columns=columns)
    fact = retail_tables.fact(spark, sf_dir) if fact is None else fact
    if not all(fit.values()):
        fact = stage(fact, "sales")
    return enrich_sales(fact, *dimensions, fit=fit, columns=columns)


def _customer_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_wide(_enriched(spark, sf_dir, CUSTOMER_WIDE_COLUMNS))


def _sales_wide(spark: SparkSession, sf_dir: str, fact: DataFrame | None = None) -> DataFrame:
    return sales_wide(_enriched(spark, sf_dir, SALES_WIDE_COLUMNS, fact))


def _folded_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all sales goes to one customer; others have no customer or an unknown one."""
    key = F.col("customer_id")
    folded = F.when(key % 3 == 0, 3).when(key % 7 == 1, None).when(key % 7 == 2, -key).otherwise(key)
    fact = retail_tables.fact(spark, sf_dir).withColumn("customer_id", folded)
    return stage(fact, "folded-sales")


def enriched_sales(spark, sf_dir):
    return _plain(_enriched(spark, sf_dir))


def enriched_sales_shuffled(spark, sf_dir):
    """Sales with a hot customer and every dimension treated as too large to broadcast."""
    none_fits = {"customer": False, "store": False, "sales_team": False}
    return _plain(enrich_sales(_folded_fact(spark, sf_dir), *_dimensions(spark, sf_dir), fit=none_fits))


def sales_without_dimension(spark, sf_dir):
    """How many of the same sales each dimension would lose."""
    return rows_without_dimension(_folded_fact(spark, sf_dir), *_dimensions(spark, sf_dir))


def customer_wide_mart(spark, sf_dir):
    return _plain(_customer_wide(spark, sf_dir))


def sales_wide_mart(spark, sf_dir):
    return _plain(_sales_wide(spark, sf_dir))


def customer_month(spark, sf_dir):
    return _plain(customer_month_mart(_customer_wide(spark, sf_dir)))


def month_total(spark, sf_dir):
    return _plain(salesperson_month_total(_sales_wide(spark, sf_dir)))


def month_rank(spark, sf_dir):
    return _plain(salesperson_rank(salesperson_month_total(_sales_wide(spark, sf_dir))))


def month_rank_ties(spark, sf_dir):
    """Ranks of totals of quantities, of which many are equal; one store has none but NULLs."""
    quantity = F.when(F.col("store_id") != 3, F.col("quantity").cast("decimal(18,2)"))
    sales = retail_tables.sales(spark, sf_dir).withColumn("total_cost", quantity)
    sales = sales.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")
    totals = salesperson_month_total(_sales_wide(spark, sf_dir, sales))
    return _plain(salesperson_rank(totals))


def salesperson_month(spark, sf_dir):
    totals = stage(salesperson_totals(_sales_wide(spark, sf_dir)), "totals")
    return _plain(salesperson_incentives(totals, small_maxima=store_months_fit(totals)))


def drift_packed_union(spark, sf_dir):
    files = file_inventory(spark, deliveries.drifting_drops(spark, sf_dir)).where("is_csv")
    return _plain(read_drops(spark, validate_headers(spark, files)))


def bad_cell_counts(spark, sf_dir):
    """What is wrong in carelessly made drops, per store."""
    files = file_inventory(spark, deliveries.careless_drops(spark, sf_dir)).where("is_csv")
    fact = read_drops(spark, validate_headers(spark, files), count_bad=True)
    return fact.groupBy("store_id").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(name).alias(name) for name in COUNTS])


def _drop_month():
    return F.regexp_extract("path", "drop_month=([^/]*)/", 1).alias("drop_month")


def source_listing(spark, sf_dir):
    """How many files were delivered for each month, and as what."""
    return file_inventory(spark, deliveries.monthly_drops(spark, sf_dir)).groupBy(_drop_month(), "is_csv").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_distinct("path").alias("n_paths"), F.count("mtime").alias("n_dated"),
        (F.min("length") > 0).alias("has_content"),
    )


def header_verdicts(spark, sf_dir):
    files = file_inventory(spark, deliveries.monthly_drops(spark, sf_dir)).where("is_csv")
    return validate_headers(spark, files).groupBy(
        _drop_month(), F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), "verdict",
    ).agg(F.count(F.lit(1)).alias("n_files"))


def rejected_files(spark, sf_dir):
    """The list of rejected files that a run writes."""
    folder = new_folder(spark, "rejecting")
    config = DailyConfig(deliveries.monthly_drops(spark, sf_dir), f"{folder}/marts", f"{folder}/ledger", jdbc_url="")
    _, _, _, rejected_dir = open_batch(spark, config, NOW, f"{folder}/work")
    return spark.read.parquet(rejected_dir).groupBy(_drop_month(), F.array_join("missing", ",").alias("missing")).agg(
        F.count(F.lit(1)).alias("n_files"))


def _order_files(spark, sf_dir):
    """Each order as a delivered file in a folder of its own, named after the customer."""
    return retail_tables.table(spark, sf_dir, "orders").select(
        F.concat_ws("/", F.lit("drops"), F.col("o_orderkey").cast("string"), F.concat(F.col("o_custkey").cast("string"), F.lit(".csv"))).alias("path"),
        F.col("o_orderdate").cast("timestamp").alias("mtime"),
        "o_orderkey", "o_orderstatus", "o_orderpriority",
    ).withColumn("file_name", base_name("path"))


def _order_ledger(spark, sf_dir):
    """All orders but those of low priority, opened at the order date; filled ones are finished, partly filled ones rejected."""
    files = _order_files(spark, sf_dir).where("o_orderpriority <> '5-LOW'")
    opened = ledger_open(files, F.col("mtime"))
    closed = ledger_close(opened, files.where("o_orderstatus = 'F'"), NOW)
    return opened.unionByName(closed).unionByName(ledger_reject(files.where("o_orderstatus = 'P'"), NOW))


def _listed_orders(spark, sf_dir):
    """The files of all orders as they lie there now: urgent ones delivered again a day later, those
    without a priority under another name."""
    renamed, urgent = (F.col("o_orderpriority") == p for p in ("4-NOT SPECIFIED", "1-URGENT"))
    again = F.regexp_replace("path", "([^/]+)$", "late-$1")
    return _order_files(spark, sf_dir).withColumns({
        "path": F.when(renamed, again).otherwise(F.col("path")),
        "mtime": F.when(urgent, F.expr("mtime + interval 1 day")).otherwise(F.col("mtime")),
    }).withColumn("file_name", base_name("path"))


def ledger_state_query(spark, sf_dir):
    state = ledger_state(_order_ledger(spark, sf_dir))
    return _plain(state.withColumn("updated_date", F.col("updated_date").cast("date")))


def ledger_in_flight_query(spark, sf_dir):
    return in_flight_names(_order_ledger(spark, sf_dir), _listed_orders(spark, sf_dir))


def pending_files_query(spark, sf_dir):
    """New, renamed and open files, and those delivered again since, whatever their status was."""
    return pending_files(_listed_orders(spark, sf_dir), _order_ledger(spark, sf_dir)).select("path", "file_name")


def partitioned_mart_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "sales-partitioned")
    write_parquet(_sales_wide(spark, sf_dir), folder, ["sales_month", "store_id"])
    back = spark.read.parquet(folder)
    return _plain(back.groupBy("sales_month", "store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_cost").alias("total_sales")
    ))


def partition_pruning(spark, sf_dir):
    """One month and one store of the partitioned mart; only their directory is read."""
    folder = new_folder(spark, "sales-partitioned")
    write_parquet(_sales_wide(spark, sf_dir), folder, ["sales_month", "store_id"])
    return _plain(spark.read.parquet(folder).where("sales_month >= '1995-03' and sales_month < '1995-06' and store_id between 5 and 12"))


def snapshot_roundtrip(spark, sf_dir):
    folder = snapshot_path(new_folder(spark, "customer-snapshot"), NOW)
    write_parquet(_customer_wide(spark, sf_dir), folder)
    return _plain(spark.read.parquet(folder))


def _late_batches(spark, sf_dir):
    """Marts of months built after a first batch, and again after one with the late sales of half the months."""
    folder = new_folder(spark, "late-batches")
    # Each sale is joined once per wide mart, with the columns of that mart only.
    dimensions = _dimensions(spark, sf_dir)
    customers_dir, sales_dir = f"{folder}/customers-wide", f"{folder}/sales-wide"
    fact, customers_fit, sales_fit = together(
        spark, lambda: stage(retail_tables.fact(spark, sf_dir), "sales"),
        *[partial(dimension_fit, *dimensions, columns=c) for c in (CUSTOMER_WIDE_COLUMNS, SALES_WIDE_COLUMNS)],
    )

    def write_customers(batch, now):
        wide = customer_wide(enrich_sales(batch, *dimensions, fit=customers_fit, columns=CUSTOMER_WIDE_COLUMNS))
        write_parquet(wide, snapshot_path(customers_dir, now))

    def write_sales(batch, now):
        wide = sales_wide(enrich_sales(batch, *dimensions, fit=sales_fit, columns=SALES_WIDE_COLUMNS))
        write_parquet(wide, snapshot_path(sales_dir, now))
        return touched_months(spark.read.schema(wide.schema).parquet(snapshot_path(sales_dir, now)))

    late = (F.dayofmonth("sales_date") > 20) & (F.month("sales_date") > 6)
    for batch, now in ((fact.where(~late), NOW), (fact.where(late), NOW + timedelta(days=1))):
        _, months = together(spark, partial(write_customers, batch, now), partial(write_sales, batch, now))
        built = rebuild_months(spark, customers_dir, sales_dir, f"{folder}/months", months)
    return built


def rebuilt_customer_months(spark, sf_dir):
    return _plain(spark.read.parquet(_late_batches(spark, sf_dir)[0]))


def rebuilt_salesperson_months(spark, sf_dir):
    return _plain(spark.read.parquet(_late_batches(spark, sf_dir)[1]))


def _database(spark: SparkSession) -> str:
    """The database to use: ``spark.tillmart.jdbc.url``, or an embedded one of this process.

    The embedded one exists in the driver's own JVM only, so without that setting the two
    queries that need a database run on a local master and not on a cluster.
    """
    return spark.conf.get(
        "spark.tillmart.jdbc.url", f"jdbc:derby:memory:tillmart{uuid.uuid4().hex};create=true"
    )


def jdbc_roundtrip(spark, sf_dir):
    url, own = _database(spark), f"t{uuid.uuid4().hex[:12]}_"
    sink, source = JdbcSink(url), JdbcSource(url)
    sink.append(retail_tables.customer(spark, sf_dir), f"{own}customer")
    customers = stage(source.read(spark, f"{own}customer", '"customer_id"', 8), "customer")
    enriched = enrich_sales(
        retail_tables.fact(spark, sf_dir), customers,
        retail_tables.store(spark, sf_dir), retail_tables.sales_team(spark, sf_dir),
    )
    mart = customer_table_rows(customer_month_mart(customer_wide(enriched)))
    sink.append(mart, f"{own}customer_mart")
    return _plain(source.read(spark, f"{own}customer_mart", '"customer_id"', 8))


def daily_run(spark, sf_dir):
    """The whole job, on all sales as drops with three different headers, in tables of its own."""
    url, own = _database(spark), f"t{uuid.uuid4().hex[:12]}_"
    sink = JdbcSink(url)
    sink.append(retail_tables.customer(spark, sf_dir), f"{own}customer")
    sink.append(retail_tables.store(spark, sf_dir), f"{own}store")
    sink.append(retail_tables.sales_team(spark, sf_dir), f"{own}sales_team")
    folder = new_folder(spark, "daily")
    run(spark, DailyConfig(
        source_dir=deliveries.drifting_drops(spark, sf_dir),
        output_dir=f"{folder}/marts",
        ledger_dir=f"{folder}/ledger",
        jdbc_url=url,
        customer_table=f"{own}customer",
        store_table=f"{own}store",
        sales_team_table=f"{own}sales_team",
        customer_mart_table=f"{own}customer_mart",
        sales_team_mart_table=f"{own}sales_team_mart",
        customer_partition_column='"customer_id"',
        store_partition_column='"id"',
        sales_team_partition_column='"id"',
    ), NOW)
    return _plain(JdbcSource(url).read(spark, f"{own}sales_team_mart", '"sales_person_id"', 8))


QUERIES = {
    "salesperson_month_mart": salesperson_month,
    "customer_month_mart": customer_month,
    "salesperson_month_total": month_total,
    "salesperson_rank": month_rank,
    "enriched_sales": enriched_sales,
    "enriched_sales_shuffled": enriched_sales_shuffled,
    "salesperson_rank_ties": month_rank_ties,
    "rows_without_dimension": sales_without_dimension,
    "bad_cell_counts": bad_cell_counts,
    "rejected_files": rejected_files,
    "partition_pruning": partition_pruning,
    "customer_wide": customer_wide_mart,
    "sales_wide": sales_wide_mart,
    "drift_packed_union": drift_packed_union,
    "file_inventory": source_listing,
    "header_verdicts": header_verdicts,
    "ledger_state": ledger_state_query,
    "ledger_in_flight": ledger_in_flight_query,
    "pending_files": pending_files_query,
    "partitioned_mart_roundtrip": partitioned_mart_roundtrip,
    "snapshot_roundtrip": snapshot_roundtrip,
    "rebuilt_customer_months": rebuilt_customer_months,
    "rebuilt_salesperson_months": rebuilt_salesperson_months,
    "jdbc_roundtrip": jdbc_roundtrip,
    "daily_run": daily_run,
}
