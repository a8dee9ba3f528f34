"""The given order tables in the shape of the retail data model.

A sale is an order line. Its store is the supplier's nation and its sales person the supplier.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.schemas import MANDATORY_COLUMNS, MONEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _names(column: str) -> list:
    parts = F.split(column, "#")
    return [parts[0].alias("first_name"), parts[1].alias("last_name")]


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        *_names("c_name"),
        F.col("c_mktsegment").alias("address"),
        F.col("c_nationkey").cast("string").alias("pincode"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("phone_number"),
        F.to_date(F.lit("2019-11-04")).alias("customer_joining_date"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("address"),
        F.col("n_regionkey").cast("string").alias("store_pincode"),
        F.concat(F.lit("MANAGER_"), F.col("n_nationkey").cast("string")).alias("store_manager_name"),
        F.to_date(F.lit("2019-11-04")).alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )


def sales_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        *_names("s_name"),
        F.col("s_nationkey").alias("manager_id"),
        F.when(F.col("s_acctbal") < 0, "Y").otherwise("N").alias("is_manager"),
        F.concat(F.lit("TEAM_"), F.col("s_nationkey").cast("string")).alias("address"),
        F.col("s_nationkey").cast("string").alias("pincode"),
        F.to_date(F.lit("2019-11-04")).alias("joining_date"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with its order and supplier.

    Plain joins: these are Parquet tables of known size, so Spark broadcasts a side only if
    it is below its own threshold, and splits skewed order keys otherwise.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.col("l_suppkey").alias("sales_person_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("sales_date"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("sales_person_id"), F.col("s_nationkey").alias("store_id")
    )
    return lines.join(orders, "l_orderkey").join(suppliers, "sales_person_id")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales columns the enriching step uses."""
    return sales(spark, sf_dir).select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")


def delivered_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with all mandatory columns, and the line's flags as unexpected ones."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
    )
    return sales(spark, sf_dir).join(part, "l_partkey").select(
        *MANDATORY_COLUMNS, "l_linenumber", "l_returnflag", "l_linestatus"
    )
