"""Perishables pricing analytics as lazy Spark DataFrame transformations."""
