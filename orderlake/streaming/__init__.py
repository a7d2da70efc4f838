"""orderlake.streaming."""
