"""Delivery and logistics analytics as Spark jobs."""
