import os
import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(Path(__file__).resolve().parent.parent), os.environ.get("PYTHONPATH", "")]
)

from tillmart import schemas

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = (
        SparkSession.builder.master("local[4]")
        .appName("tillmart-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def customer(spark):
    rows = [
        (1, "Ann", "Ash", "Elm St 1", "111", "555-1", date(2021, 1, 1)),
        (2, "Bob", None, "Elm St 2", "222", "555-2", date(2021, 1, 2)),
        (3, "Cid", "Cox", "Elm St 3", "333", "555-3", date(2021, 1, 3)),
    ]
    return spark.createDataFrame(rows, schemas.CUSTOMER)


@pytest.fixture(scope="session")
def store(spark):
    rows = [
        (121, "Market Sq", "900", "Mia", date(2020, 1, 1), "fine"),
        (122, "Harbour", "901", "Max", date(2020, 1, 1), None),
    ]
    return spark.createDataFrame(rows, schemas.STORE)


@pytest.fixture(scope="session")
def sales_team(spark):
    rows = [
        (1, "Sam", "Sun", 31, "no", "Hill 1", "701", date(2019, 11, 4)),
        (2, "Tia", "Tor", 31, "no", "Hill 2", "702", date(2019, 11, 4)),
        (3, "Uma", None, 31, "yes", "Hill 3", "703", date(2019, 11, 4)),
    ]
    return spark.createDataFrame(rows, schemas.SALES_TEAM)


@pytest.fixture(scope="session")
def make_fact(spark):
    """Fact rows from (customer, store, date, sales person, total cost)."""
    def make(rows):
        full = [
            (c, s, "soap", d and date.fromisoformat(d), p, Decimal("1.00"), 1, t and Decimal(t), None)
            for c, s, d, p, t in rows
        ]
        return spark.createDataFrame(full, schemas.FACT)
    return make


@pytest.fixture
def write_file(tmp_path):
    def write(name, text=""):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return path
    return write


def tuples(df, *columns):
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(row) for row in rows), key=repr)
