"""Whole jobs."""

from .jobs import (
    ad_hoc_report, ad_hoc_slices, arrival_reports, exact_range_report, exact_report, export_events, merge_files, merge_reports, pba_rows,
    store_reports, stored_report, tba, tba_and_pba, ten_minute_reports,
)
from .upkeep import merge_file_reports, redo_late, redo_windows, scan_blocks, store_blocks, touched_windows

__all__ = [
    "ad_hoc_report", "ad_hoc_slices", "arrival_reports", "exact_range_report", "exact_report", "export_events", "merge_file_reports",
    "merge_files", "merge_reports", "pba_rows", "redo_late", "redo_windows", "scan_blocks", "store_blocks", "store_reports",
    "stored_report", "tba", "tba_and_pba", "ten_minute_reports", "touched_windows",
]
