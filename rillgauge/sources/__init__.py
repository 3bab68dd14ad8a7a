"""Scans of the raw and stored tables, and the sinks that write them."""
