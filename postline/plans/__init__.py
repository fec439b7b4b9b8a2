"""Operators composed into runs."""
