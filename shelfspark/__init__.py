"""Retail demand analytics as Spark jobs: cleaning, profiling, features, segmentation, forecasting and evaluation."""

__version__ = "0.1.0"
