"""Scans and loaders: trip Parquet ingest, zone CSV, seeds, and driver-table adapters."""

from .ingest import (  # noqa: F401
    coalesce_spellings, ingest_trips, load_files, load_if_absent, load_months, new_files, read_landing, rows_loaded,
    target_months, with_lineage,
)
from .seeds import read_zones, seed  # noqa: F401
