from tillmart.sinks.jdbc import JdbcSink
from tillmart.sinks.parquet import snapshot_id, snapshot_path, write_parquet

__all__ = ["JdbcSink", "snapshot_id", "snapshot_path", "write_parquet"]
