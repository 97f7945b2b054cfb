"""Registered queries: each takes (spark, folder of the source tables) and returns a DataFrame."""
