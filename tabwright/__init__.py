"""Tabular customer analytics as Spark jobs: contracts, profiling, leakage-safe
preprocessing, cross-validation, exact metrics, calibration, importance, drift."""

__version__ = "0.1.0"
