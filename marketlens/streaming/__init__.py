"""Feeding bronze from files as they land."""
