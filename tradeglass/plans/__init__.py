"""Stored tables and the scheduled jobs."""
