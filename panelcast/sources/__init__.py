"""Reading and writing series tables."""

from panelcast.sources.files import (
    csv_report,
    load_model,
    read_series_csv,
    read_series_parquet,
    save_model,
    write_daily,
    write_series,
    write_series_csv,
)
from panelcast.sources.shapes import canonicalize, to_long, to_wide

__all__ = [
    "csv_report",
    "canonicalize",
    "load_model",
    "read_series_csv",
    "read_series_parquet",
    "save_model",
    "to_long",
    "to_wide",
    "write_daily",
    "write_series",
    "write_series_csv",
]
