"""Session settings, scratch tables and the query catalogue."""
