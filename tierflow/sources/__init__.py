"""Scans, sinks and the table layout; every path goes through the Hadoop file system."""
