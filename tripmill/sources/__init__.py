"""Schemas, readers, the date spine and the trip-shaped view of the star tables."""
