"""Arriving data: extending an output, and daily bins of a stream."""
