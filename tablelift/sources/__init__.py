"""Reading, writing and comparing table snapshots."""

from tablelift.sources.changes import change_catalog, change_lists, invalid_changes, read_change_files
from tablelift.sources.files import file_manifest, file_plan, mirror_files, write_files
from tablelift.sources.guards import has_column, has_table, run_if
from tablelift.sources.mirror import apply_mirror, mirror_plan
from tablelift.sources.report import report_document, report_lines, write_report, write_report_object
from tablelift.sources.snapshots import SnapshotStore, read_declared, read_jdbc, read_table, run_sql

__all__ = [
    "SnapshotStore",
    "apply_mirror",
    "change_catalog",
    "change_lists",
    "file_manifest",
    "file_plan",
    "has_column",
    "has_table",
    "invalid_changes",
    "mirror_files",
    "mirror_plan",
    "read_change_files",
    "read_declared",
    "read_jdbc",
    "read_table",
    "report_document",
    "report_lines",
    "run_if",
    "run_sql",
    "write_files",
    "write_report",
    "write_report_object",
]
