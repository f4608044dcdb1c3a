"""Batch analytics for a star schema of dated hires, as Spark jobs."""

from .operators.normalise import normalise_history
from .operators.refined import refine_rows
from .plans.history import ingest, normalise_files
from .plans.landing import append_capped_csv, append_records
from .plans.refine import refine
from .plans.reports import (
    departments_above_mean,
    hires_by_quarter,
    hires_enriched,
    hires_in_year,
    mean_hires,
    store_departments_above_mean,
    summarise_year,
)
from .plans.snapshot import backup_table, backup_tables, restore_table, restore_tables
from .streaming.epochs import epochs_of
from .streaming.landing import (
    land_capped_csv,
    land_records,
    landed_counts,
    read_landed,
    stream_csv_into,
    stream_records_into,
)

__all__ = [
    "append_capped_csv",
    "append_records",
    "backup_table",
    "backup_tables",
    "departments_above_mean",
    "epochs_of",
    "hires_by_quarter",
    "hires_enriched",
    "hires_in_year",
    "ingest",
    "land_capped_csv",
    "land_records",
    "landed_counts",
    "mean_hires",
    "normalise_files",
    "normalise_history",
    "read_landed",
    "refine",
    "refine_rows",
    "restore_table",
    "restore_tables",
    "store_departments_above_mean",
    "stream_csv_into",
    "stream_records_into",
    "summarise_year",
]
