"""Negative-stock alerts as streams."""
