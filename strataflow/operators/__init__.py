"""Reusable table operators. Each takes DataFrames and returns one."""
