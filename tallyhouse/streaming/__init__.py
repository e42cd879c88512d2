"""Records as they arrive."""
