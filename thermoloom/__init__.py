"""Spark-native feature, report and forecast engine for temperature readings.

Every public function maps DataFrames to DataFrames and is keyed by ``source``
(which upload a reading came from) and ``place`` (indoor or outdoor), so one
job serves any number of sources.
"""
