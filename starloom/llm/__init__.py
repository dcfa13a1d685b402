"""Operators for training corpora: mixing, filters, near copies, counts and scans."""
