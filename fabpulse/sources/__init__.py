"""Readers, and the generated dimensions."""
