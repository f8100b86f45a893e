"""Registered queries: each operator bound to the driver tables, with its oracle SQL."""
