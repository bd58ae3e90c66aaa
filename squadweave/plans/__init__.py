"""Operators put together: the roster build and the queries on the driver tables."""
