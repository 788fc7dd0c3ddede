"""Readers, writers and file listings."""

from eventloom.sources.clustering import write_curved
from eventloom.sources.days import available_days, day_plan, list_day_paths, read_day_range, read_days
from eventloom.sources.listing import folder_files, list_files, path_exists, remove_folder
from eventloom.sources.readers import (
    read_csv,
    read_csv_inferred,
    read_file_list,
    read_glob,
    read_json,
    read_orc,
    read_parquet,
    read_partitioned,
    union_all_by_name,
)
from eventloom.sources.writers import convert, write_clustered, write_parquet, write_partitioned

__all__ = [name for name in dir() if not name.startswith("_")]
