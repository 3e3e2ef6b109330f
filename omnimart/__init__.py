"""Omnichannel retail analytics expressed as PySpark DataFrame jobs."""
