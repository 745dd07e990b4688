"""Sources, sinks and the occurrence store."""
