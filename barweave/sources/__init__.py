"""Readers of landed files and tables, all with explicit schemas."""
