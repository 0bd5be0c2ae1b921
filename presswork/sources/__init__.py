"""Table, dictionary and feed sources, and conflict-ignoring sinks."""
