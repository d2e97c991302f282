"""Retail demand features, forecasting and audit as Spark DataFrame jobs."""
