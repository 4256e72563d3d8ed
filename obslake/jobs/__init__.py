"""Command line entry points (``python -m obslake.jobs.<name>`` or spark-submit)."""
