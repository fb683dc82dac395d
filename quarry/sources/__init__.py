"""Readers, fixtures derived from the driver tables, sinks and materialisation."""
