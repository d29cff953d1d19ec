"""Registered queries: each module maps a name to (query, oracle SQL or None)."""
