"""arealens: yearly performance indicators for station areas, corridors and zones, on Spark."""

__version__ = "0.1.0"
