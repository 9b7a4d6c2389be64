"""Table scans and sinks."""

from herdloom.sources.daily import archive_days, read_daily, write_daily
from herdloom.sources.files import Folder
from herdloom.sources.sinks import (
    export_lists,
    purge_run,
    read_extract,
    read_extract_in_splits,
    refresh,
    replace_partitions,
    split_valid_error,
    stage,
    stamp,
    write_extract,
)
from herdloom.sources.tables import TABLES, read_jdbc, read_table, shared_path
from herdloom.sources.versions import current, publish, read_current

__all__ = [
    "TABLES",
    "Folder",
    "archive_days",
    "current",
    "export_lists",
    "publish",
    "purge_run",
    "read_current",
    "read_daily",
    "read_extract",
    "read_extract_in_splits",
    "read_jdbc",
    "read_table",
    "refresh",
    "replace_partitions",
    "shared_path",
    "split_valid_error",
    "stage",
    "stamp",
    "write_daily",
    "write_extract",
]
