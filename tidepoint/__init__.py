"""Move, reshape and check time-series points with Spark DataFrames."""

from tidepoint.points import FieldMap, Mapping, PointsSchema, TagMap

__all__ = ["FieldMap", "Mapping", "PointsSchema", "TagMap"]
