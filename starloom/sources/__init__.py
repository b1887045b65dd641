"""Tables in and out."""

from starloom.sources.bucketed import bucket_count, forget_bucketed, read_bucketed, write_bucketed
from starloom.sources.landing import Landed, land_delimited
from starloom.sources.ordered import file_ranges, write_ordered
from starloom.sources.readers import (
    checked_delimited,
    normalise_headers,
    read_delimited,
    read_delimited_inferred,
    read_format,
    read_label_list,
    read_parquet,
    register_views,
    run_sql,
)
from starloom.sources.writers import append_table, rows_written, write_table

__all__ = [
    "Landed",
    "append_table",
    "bucket_count",
    "checked_delimited",
    "file_ranges",
    "forget_bucketed",
    "land_delimited",
    "normalise_headers",
    "read_bucketed",
    "read_delimited",
    "read_delimited_inferred",
    "read_format",
    "read_label_list",
    "read_parquet",
    "register_views",
    "rows_written",
    "run_sql",
    "write_bucketed",
    "write_ordered",
    "write_table",
]
