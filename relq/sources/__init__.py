"""Declared schemas, table scans and sinks, and the read-only SQL entry."""
