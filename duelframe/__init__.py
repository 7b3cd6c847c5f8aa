"""Matchup analytics on Spark DataFrames.

Two-sided events (home against away at a point in time), quotes about them,
rating snapshots of the sides, and everything as of a cutoff.
"""
