"""Reusable DataFrame operators of the revenue mart."""
