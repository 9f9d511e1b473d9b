"""Alignment, audit, curation and scoring of multi-rate robot-demonstration logs on Spark."""
