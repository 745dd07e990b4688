"""Pipelines from occurrences to profiles."""
