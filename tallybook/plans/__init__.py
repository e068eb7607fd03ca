"""Operators chained into whole jobs and named reports."""
