"""Tabular profiling, preparation and classification as Spark jobs."""
