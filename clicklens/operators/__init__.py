"""Operators Spark has no single call for, composed from DataFrame operations."""
