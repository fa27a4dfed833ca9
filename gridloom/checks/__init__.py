"""Registered queries over the test tables, each next to its oracle SQL."""
