"""Spark jobs for radio-interferometry visibilities."""
