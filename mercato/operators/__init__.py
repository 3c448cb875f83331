"""Operators over DataFrames: merge, events, sessions, privacy, governance, checks."""
