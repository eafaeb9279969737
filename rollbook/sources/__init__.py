"""Readers, and the versioned table folder."""
