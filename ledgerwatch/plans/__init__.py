"""Operators put together: rule runs, marts, the whole pipeline."""
