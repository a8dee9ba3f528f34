from tillmart.sources.drops import empty_fact, read_drops, read_layout, read_mixed
from tillmart.sources.headers import header_columns, validate_headers
from tillmart.sources.inventory import file_inventory
from tillmart.sources.jdbc import JdbcSource

__all__ = [
    "JdbcSource", "empty_fact", "file_inventory", "header_columns", "read_drops", "read_layout", "read_mixed",
    "validate_headers",
]
