"""Monitoring-metric ingestion on Spark: decode, check, route, write, back up, restore.

Every step is a ``DataFrame -> DataFrame`` function made of built-in Spark
expressions, so the same code serves batch tables and micro-batches.
"""

from tidegate.session import prepare_session, scratch_folder

__all__ = ["prepare_session", "scratch_folder"]
