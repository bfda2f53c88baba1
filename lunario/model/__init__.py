"""Spark ML stages, the forecasting model and its grid search."""
