"""Audiences, reports and SQL statements."""
