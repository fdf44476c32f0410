"""Assembled jobs: train, enrich, score, report."""
