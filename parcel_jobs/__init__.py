"""Batch jobs for county property records, as DataFrame code."""
