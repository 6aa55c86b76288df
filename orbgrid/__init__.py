"""Gridded geophysical fields on Spark: from regular lat/lon grids to HEALPix pyramids."""

__version__ = "0.1.0"
