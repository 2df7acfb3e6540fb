"""Spark jobs for the data side of training coding agents."""
