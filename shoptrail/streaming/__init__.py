"""Scoring requests that keep arriving, with the batch code."""
