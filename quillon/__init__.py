"""Scoring and triage of large keyed collections of structured strings, on Spark."""
