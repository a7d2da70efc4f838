"""orderlake.operators."""
