"""Readers and writers of raw files, stage tables and request logs, and the collectors."""
