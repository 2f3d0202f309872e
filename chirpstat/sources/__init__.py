"""Sources, sinks and test fixtures."""
