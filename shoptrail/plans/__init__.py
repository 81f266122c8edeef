"""Operators put together: cleaning, training, scoring and the staged run."""
