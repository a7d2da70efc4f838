"""orderlake.sinks."""
