"""Operators over points: filters, mapping, slicing, numbering, upsert, reconciliation."""
