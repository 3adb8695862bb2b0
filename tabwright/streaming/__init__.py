"""Fitted scoring on unbounded input."""
