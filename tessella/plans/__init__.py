"""Registered queries, each beside its oracle SQL."""
