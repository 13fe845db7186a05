"""Bulletin: ranked notice digests as Spark DataFrame jobs."""
