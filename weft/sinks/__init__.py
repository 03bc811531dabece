"""Writers: text, Parquet, CSV, selected by name."""
