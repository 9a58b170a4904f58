"""Readers and idempotent writers."""
