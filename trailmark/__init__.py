"""Spark-native toolkit that groups dated, geolocated records into field trips."""

__version__ = "0.1.0"
