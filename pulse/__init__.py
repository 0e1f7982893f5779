"""Pulse: technology trends in community story feeds, as Spark DataFrame jobs."""
