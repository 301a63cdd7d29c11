"""Operators for preparing training text: counts, fingerprints, near copies, scans, mixing."""
