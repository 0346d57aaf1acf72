"""Sources, sinks and the schemas they share."""
