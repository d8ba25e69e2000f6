"""Satellite hotspot analytics as composable Spark DataFrame functions."""
