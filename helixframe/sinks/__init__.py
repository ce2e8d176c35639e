"""Clustered table writes and named intermediates."""
