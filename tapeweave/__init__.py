"""Historical futures bars on Spark: normalise, resample, stitch, keep, inspect, export."""

__version__ = "0.1.0"
