"""Gridded weather-forecast analytics as Spark jobs."""
