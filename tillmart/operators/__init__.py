from tillmart.operators.enrich import customer_wide, dimension_fit, enrich_sales, rows_without_dimension, sales_wide
from tillmart.operators.ledger import (
    append_ledger,
    in_flight_names,
    ledger_close,
    ledger_in_flight,
    ledger_open,
    ledger_reject,
    ledger_state,
    pending_files,
    read_ledger,
)
from tillmart.operators.lookup import JoinBounds, fits_broadcast, hot_keys, lookup_join
from tillmart.operators.marts import (
    INCENTIVE_RATE,
    customer_month_mart,
    customer_table_rows,
    sales_team_table_rows,
    salesperson_month_mart,
    salesperson_month_total,
    salesperson_rank,
    store_months_fit,
)

__all__ = [
    "INCENTIVE_RATE", "JoinBounds", "append_ledger", "customer_month_mart", "customer_table_rows",
    "customer_wide", "dimension_fit", "enrich_sales", "fits_broadcast", "hot_keys",
    "in_flight_names", "ledger_close", "ledger_in_flight", "ledger_open", "ledger_reject",
    "ledger_state", "lookup_join", "pending_files", "read_ledger", "rows_without_dimension",
    "sales_team_table_rows", "sales_wide", "salesperson_month_mart", "salesperson_month_total",
    "salesperson_rank", "store_months_fit",
]
