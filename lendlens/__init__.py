"""Applicant scoring on Spark: roll-ups, transforms, feature families, models and acceptance metrics."""

__version__ = "0.1.0"
