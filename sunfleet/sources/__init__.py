"""Readers, writers and the event-log adapter."""
