"""Presence analytics over building-access logs, as DataFrame-to-DataFrame functions on Spark."""
