"""Serving models over tables and streams while the models change."""
