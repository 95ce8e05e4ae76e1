"""Readers, landing jobs, table loads and sinks."""
