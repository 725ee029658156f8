"""Subscription engagement and churn analytics as Spark DataFrame jobs."""
