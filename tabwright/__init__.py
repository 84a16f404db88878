"""Tabular survey, sales and feed analytics as Spark jobs."""
