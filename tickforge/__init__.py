"""Spark jobs for market time-series: parse, clean, resample, features, quality."""
