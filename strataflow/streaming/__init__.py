"""Structured Streaming forms of the jobs, and running them."""
