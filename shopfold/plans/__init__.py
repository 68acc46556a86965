"""User-level pipelines (run modes) and the registered query catalog."""
