"""Scans, sinks, table registry and the fixture views over the test tables."""
