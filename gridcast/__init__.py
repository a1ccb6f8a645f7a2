"""Keyed hourly time series on Spark: landing, grid alignment, gap filling, features,
quality gating, forecasting models, attribution and monitoring, all as DataFrame plans."""
