"""Landing zone, catalog tables and staging."""
