"""Structured Streaming jobs: counters, recall lists, profiles, deduplication."""
