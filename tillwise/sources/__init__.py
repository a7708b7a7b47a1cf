"""Sources (table loading) and sinks (result writing)."""

from tillwise.sources.tables import SCHEMAS, Tables, load_tables, read_jdbc_table
from tillwise.sources.sinks import write_result

__all__ = ["SCHEMAS", "Tables", "load_tables", "read_jdbc_table", "write_result"]
