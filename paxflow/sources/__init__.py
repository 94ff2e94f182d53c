"""Sources (booking lines, airports, test-table bridge) and sinks."""
