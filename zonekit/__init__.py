"""zonekit: spatio-temporal feature, encoding, ranking and evaluation jobs on Spark."""

__version__ = "0.1.0"
