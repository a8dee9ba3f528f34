"""Column contracts of the sales drops, the dimension tables and the marts."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TABLE_MONEY = T.DecimalType(10, 2)


def _struct(**columns):
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# The eight columns every drop must carry, and their types.
SALES_COLUMNS = {
    "customer_id": T.IntegerType(),
    "store_id": T.IntegerType(),
    "product_name": T.StringType(),
    "sales_date": T.DateType(),
    "sales_person_id": T.IntegerType(),
    "price": MONEY,
    "quantity": T.IntegerType(),
    "total_cost": MONEY,
}
MANDATORY_COLUMNS = list(SALES_COLUMNS)

FACT = _struct(**SALES_COLUMNS, additional_column=T.StringType())

# The columns of the database tables and of the ledger.
CUSTOMER = _struct(
    customer_id=T.IntegerType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    address=T.StringType(),
    pincode=T.StringType(),
    phone_number=T.StringType(),
    customer_joining_date=T.DateType(),
)

STORE = _struct(
    id=T.IntegerType(),
    address=T.StringType(),
    store_pincode=T.StringType(),
    store_manager_name=T.StringType(),
    store_opening_date=T.DateType(),
    reviews=T.StringType(),
)

SALES_TEAM = _struct(
    id=T.IntegerType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    manager_id=T.IntegerType(),
    is_manager=T.StringType(),
    address=T.StringType(),
    pincode=T.StringType(),
    joining_date=T.DateType(),
)

LEDGER = _struct(
    file_name=T.StringType(),
    file_location=T.StringType(),
    file_mtime=T.TimestampType(),
    created_date=T.TimestampType(),
    updated_date=T.TimestampType(),
    status=T.StringType(),
)

# The columns of the enriched fact and of the two wide marts.
ENRICHED_COLUMNS = [
    "store_id", "sales_date", "sales_person_id", "total_cost",
    "customer_id", "first_name", "last_name", "address", "pincode", "phone_number",
    "store_address", "store_manager_name",
    "manager_id", "is_manager", "joining_date",
    "sales_person_first_name", "sales_person_last_name",
    "sales_person_address", "sales_person_pincode",
]

CUSTOMER_WIDE_COLUMNS = [
    "customer_id", "first_name", "last_name", "address", "pincode", "phone_number",
    "sales_date", "total_cost",
]

# sales_month is derived and comes last.
SALES_WIDE_COLUMNS = [
    "store_id", "sales_person_id", "sales_person_first_name", "sales_person_last_name",
    "store_manager_name", "manager_id", "is_manager",
    "sales_person_address", "sales_person_pincode", "sales_date", "total_cost",
]
