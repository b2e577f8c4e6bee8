"""Operators of a training-data pipeline over texts; nothing else in the library imports them."""
