"""Idempotent writers: replace a date partition, upsert by key."""
