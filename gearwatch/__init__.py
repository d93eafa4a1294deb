"""Machine-sensor analytics on Spark: clean, featurise, label, split, train, explain, score."""

from gearwatch.options import LogOptions

__all__ = ["LogOptions"]
