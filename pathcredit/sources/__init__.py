"""Inputs (fixture adapter over the driver's tables) and stored tables with keyed upsert."""
