"""Sources (table loader, topic readers, journal) and sinks."""
