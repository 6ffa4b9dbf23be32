"""Operators for preparing training text at scale: dedup, cleaning, scans, mixing, token files."""
