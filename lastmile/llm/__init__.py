"""Operators for preparing training text, and the queries registered for them."""
