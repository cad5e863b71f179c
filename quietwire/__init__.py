"""Spark jobs that separate the few market-moving news items from the daily noise."""
