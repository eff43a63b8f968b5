"""Writers."""

from .csv import event_layout, report_layout, write_layout, write_reports, write_resampled
from .snapshots import CommitConflict, commit, read_table, remove_old_files, snapshot
from .tables import (
    append_rows, commit_slices, merge_report_store, merge_slices, store_form, stored_table, write_days, write_json_lines,
    write_report_store, write_sorted,
)

__all__ = [
    "CommitConflict", "append_rows", "commit", "commit_slices", "event_layout", "merge_report_store", "merge_slices", "read_table", "remove_old_files",
    "report_layout", "snapshot", "store_form", "stored_table", "write_days", "write_json_lines",
    "write_layout", "write_report_store", "write_reports", "write_resampled", "write_sorted",
]
