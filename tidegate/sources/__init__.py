from tidegate.sources.scans import (
    dated_name,
    drop_view,
    expose_view,
    read_catalog,
    read_csv,
    read_dependency,
    read_parquet,
)
from tidegate.sources.schema import (
    TableColumn,
    map_type,
    partition_columns,
    scan_schema,
    table_columns,
)

__all__ = [
    "TableColumn",
    "dated_name",
    "drop_view",
    "expose_view",
    "map_type",
    "partition_columns",
    "read_catalog",
    "read_csv",
    "read_dependency",
    "read_parquet",
    "scan_schema",
    "table_columns",
]
