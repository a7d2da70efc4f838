"""orderlake.plans."""
