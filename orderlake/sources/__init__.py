"""orderlake.sources."""
