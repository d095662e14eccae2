"""Sources and sinks: delta extract, CSV staging, versioned table store."""
