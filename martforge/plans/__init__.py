"""Load plans and the registered query catalogue."""
