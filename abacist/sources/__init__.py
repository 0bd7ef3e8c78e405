"""Readers, writers and input selection."""
