"""Operators put together: full build, incremental runs, checks, query catalog."""
