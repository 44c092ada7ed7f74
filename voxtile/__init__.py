"""Spatial objects, label volumes, region statistics and group contrasts as Spark plans."""
