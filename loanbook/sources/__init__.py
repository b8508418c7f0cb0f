"""Input tables and output sinks."""
