"""Scans and sinks: trip tables, driver tables, reduced-trip files, run
log and saved pipelines."""
