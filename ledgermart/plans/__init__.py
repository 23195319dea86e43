"""Composed models (core, star schema, reports) and recipes on the driver's tables."""
