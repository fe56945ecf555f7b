from titlemart.sinks.export import export_table
from titlemart.sinks.tables import (
    compact_table,
    copy_tables,
    create_empty_table,
    create_view,
    describe_table,
    expire_partitions,
    read_table,
    table_exists,
    write_table,
)

__all__ = [
    "compact_table",
    "copy_tables",
    "create_empty_table",
    "create_view",
    "describe_table",
    "expire_partitions",
    "export_table",
    "read_table",
    "table_exists",
    "write_table",
]
