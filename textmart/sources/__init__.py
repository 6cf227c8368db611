"""Readers and writers of the model's files and tables."""

from textmart.sources.read import (
    read_dictionary,
    read_entries_json,
    read_entries_json_array,
    read_entries_json_lines,
    read_html_cache_csv,
    read_html_cache_jdbc,
    read_html_cache_table,
    read_job_ids_csv,
    read_processed_ids,
)
from textmart.sources.write import (
    append_ids_csv,
    ensure_schema,
    write_checked_model,
    write_entries_json,
    write_html_csv,
    write_mart_csv,
    write_model,
)

__all__ = [
    "append_ids_csv",
    "ensure_schema",
    "read_dictionary",
    "read_entries_json",
    "read_entries_json_array",
    "read_entries_json_lines",
    "read_html_cache_csv",
    "read_html_cache_jdbc",
    "read_html_cache_table",
    "read_job_ids_csv",
    "read_processed_ids",
    "write_checked_model",
    "write_entries_json",
    "write_html_csv",
    "write_mart_csv",
    "write_model",
]
