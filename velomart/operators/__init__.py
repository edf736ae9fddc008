"""Transformations: staging, marts, weather reshaping, reports and quality checks."""
