from stackyard.sources.tables import load, nan_to_null, read_csv_table  # noqa: F401
