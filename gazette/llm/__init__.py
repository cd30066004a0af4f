"""Operators for preparing training text at scale, each a DataFrame-to-DataFrame function."""
