"""Sources and sinks: driver tables, annotation exports, CSV/Parquet/archives."""
