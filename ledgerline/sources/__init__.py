from ledgerline.sources.readers import (
    EmptyResultError,
    MissingColumnError,
    filtered_loans,
    insight_table,
    in_memory_table,
    macro_series,
    read_csv,
    read_table,
    text_schema,
    year_distribution,
)
from ledgerline.sources.writers import (
    old_versions, preview, read_version, schema_report, table_report, write_csv, write_table, write_version,
)

__all__ = [
    "EmptyResultError", "MissingColumnError", "filtered_loans", "insight_table", "in_memory_table",
    "macro_series", "old_versions", "preview", "read_csv", "read_table", "read_version", "schema_report", "table_report", "text_schema",
    "write_csv", "write_table", "write_version", "year_distribution",
]
