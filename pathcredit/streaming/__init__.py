"""Incremental runs: manifest high-water marks, lookback bounds, upserts into stored tables."""
