"""Registered queries over the driver tables, the views they start from, and the daily jobs."""
