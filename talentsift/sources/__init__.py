"""Readers and writers, and the mapping from the sample tables to domain frames."""
