"""Micro-batch runs with exactly-once output."""
