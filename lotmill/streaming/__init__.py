"""Continuous runs of the batch operators."""
