"""Jobs, the query catalog and the ML steps."""
