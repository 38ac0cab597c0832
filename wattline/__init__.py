"""Electricity-grid analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
``functions``  column expressions (time, keys, measures, labels)
``sources``    payload, event and table readers plus bronze landing
``operators``  reusable DataFrame operators (dedup, upsert, contracts, checks)
``plans``      the jobs: bronze, silver, gold, monitoring, insights
``streaming``  Structured Streaming ingestion, rollups, alerts, health
"""
