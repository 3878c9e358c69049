"""Sources (JSON landing directories) and sinks (versioned table snapshots)."""
