"""Readers, sinks, type sniffing and page extraction."""
