"""Per-key ordered record streams.

The reference has no Structured Streaming job; its "streams" are per-key,
time-sorted iterators consumed by custom code (a grouped secondary sort).
:mod:`.keyed_stream` gives that contract on DataFrames with bounded groups.
"""
