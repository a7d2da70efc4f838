"""orderlake.functions."""
