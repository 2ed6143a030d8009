"""Fraud-risk features, labels, scores and monitoring as Spark jobs."""
