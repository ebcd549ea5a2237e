"""Readers: driver tables, text directories, message topics."""

from cascata.sources.tables import (SCHEMAS, TABLES, read_table, schema_of, stream_parquet, stream_table,
                                    table_path)

__all__ = ["SCHEMAS", "TABLES", "read_table", "schema_of", "stream_parquet", "stream_table", "table_path"]
