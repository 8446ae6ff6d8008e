"""Churn analytics over subscription-service activity logs, on Spark DataFrames."""
