"""Writing tables, records and JSON output."""
