"""Operators put together: the daily run, the views, and the registered queries."""
