"""Registered queries, their SQL oracle, and batch jobs."""
