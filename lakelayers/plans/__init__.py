"""Layer jobs and the daily run."""
