"""Feeds to wide table to reports, composed from the operators."""
