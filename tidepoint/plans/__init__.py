"""Whole runs: one mapping, or a windowed backfill over shard groups."""
