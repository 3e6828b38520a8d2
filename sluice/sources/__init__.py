"""Files, tables, cell stores and message logs."""
