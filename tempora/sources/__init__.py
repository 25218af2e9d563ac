"""Batch and streaming sources, and the keyed sinks."""

from tempora.sources.files import (
    CITY_COLUMN_TYPES,
    list_entries,
    newest_drop_name,
    read_csv,
    read_newest_drop,
    read_serving_table,
    read_table,
)

__all__ = ["CITY_COLUMN_TYPES", "list_entries", "newest_drop_name", "read_csv", "read_newest_drop",
           "read_serving_table", "read_table"]
