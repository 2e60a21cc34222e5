"""Whole jobs made of the operators: reports and the daily load."""
