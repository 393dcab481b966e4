"""Feeds, message envelopes, tables."""
