"""Operators put together: the daily-spend plan, the file pipeline, the query catalogue."""
