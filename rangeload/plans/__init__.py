"""Offset arithmetic and the planning of ranges."""
