"""Reusable plan shapes: skew-aware joins, interval joins and binned scans."""
