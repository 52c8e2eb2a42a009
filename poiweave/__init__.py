"""Geo-located points of interest from public wiki dumps, as Spark DataFrame jobs."""

__version__ = "0.1.0"
