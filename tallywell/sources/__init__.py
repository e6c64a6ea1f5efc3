"""Readers, fixed dimensions and writers."""
