"""Command-line jobs for spark-submit."""
