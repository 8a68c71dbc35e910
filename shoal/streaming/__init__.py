"""Keyed-state processors and streaming jobs."""
