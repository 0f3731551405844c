"""Incremental runs driven by landing events."""
