from .readers import scan_calendar, scan_splits, scan_table
from .writers import append_run, append_with_backup, nested_topn, read_history, write_replace

__all__ = [
    "scan_calendar", "scan_splits", "scan_table",
    "append_run", "append_with_backup", "nested_topn", "read_history", "write_replace",
]
