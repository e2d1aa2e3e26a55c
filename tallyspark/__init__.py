"""Spark-native analytics jobs: retail value, news and graph scoring, market risk, forecasting, ingestion."""
