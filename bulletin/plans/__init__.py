"""Whole-issue plans and the query catalog."""
