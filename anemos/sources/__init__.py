"""Readers. All of them are lazy and read nothing on the driver but file lists."""

from .events import message_schema, read_messages
from .inventory import file_inventory, file_schemas, list_files, type_conflicts
from .lookups import (
    read_condition_labels, read_curves, read_grid_dates, read_turbine_info, standard_curves,
)
from .reports import report_rows, scan_reports
from .telemetry import (
    day_folder_glob, scan_arrivals, scan_day_folders, scan_device_day, scan_files_named, scan_telemetry,
    with_file_keys,
)

__all__ = [
    "day_folder_glob", "file_inventory", "file_schemas", "list_files", "message_schema", "read_condition_labels",
    "read_curves", "read_grid_dates", "read_messages", "read_turbine_info", "report_rows",
    "scan_arrivals", "scan_day_folders", "scan_device_day", "scan_files_named", "scan_reports",
    "scan_telemetry", "standard_curves", "type_conflicts", "with_file_keys",
]
